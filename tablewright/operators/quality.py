"""Data-quality checks (Q1-Q9).

SQL Server enforces PRIMARY KEY / FOREIGN KEY / NOT NULL when rows are
written; Spark tables do not, so the declared rules become checks that
return the violating keys. Each check is one distributed job (aggregate or
anti join); nothing is pulled to the driver except one-row summaries.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_counts(df: DataFrame, columns: list[str] | None = None,
                total: str | None = None) -> DataFrame:
    """One row: NULL count per column (and the row count as ``total``), one pass."""
    columns = list(columns or df.columns)
    aggs = [F.count(F.lit(1)).alias(total)] if total else []
    aggs += [F.sum(F.when(F.col(f"`{c}`").isNull(), 1).otherwise(0)).cast("bigint").alias(c)
             for c in columns]
    return df.agg(*aggs)


def null_counts_long(df: DataFrame, table_name: str, columns: list[str]) -> DataFrame:
    """(TableName, ColumnName, NullRows) per column; one aggregate, then unpivot."""
    wide = null_counts(df, columns)
    return (wide.unpivot([], columns, "ColumnName", "NullRows")
            .select(F.lit(table_name).alias("TableName"), "ColumnName",
                    F.col("NullRows").cast("bigint").alias("NullRows")))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once (primary-key check), with their row count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("DuplicateRows"))
            .filter(F.col("DuplicateRows") > 1))


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent (foreign-key check)."""
    parents = parent.select(F.col(parent_key).alias("_fk_parent"))
    return (child.filter(F.col(child_key).isNotNull())
            .join(parents, F.col(child_key) == F.col("_fk_parent"), "left_anti"))


def _missing(df: DataFrame) -> Column:
    """NULL cells of a row."""
    cells = [F.when(F.col(f"`{c}`").isNull(), 1).otherwise(0) for c in df.columns]
    return reduce(lambda x, y: x + y, cells, F.lit(0))


def profile(df: DataFrame) -> DataFrame:
    """One row: rows, columns, missing_values, duplicate_rows (rows that repeat an earlier one).

    Rows are grouped by a 128-bit fingerprint, so what is shuffled for a row doesn't grow
    with its width. Identical rows (NULLs equal) always share a fingerprint, so a fingerprint
    met once is a distinct row; only the rows of a repeated one are compared in full. The
    result is exact even where fingerprints of different rows collide. An empty table has 0
    everywhere but in ``columns``.
    """
    cells = [F.col(f"`{c}`") for c in df.columns]
    # The hash skips NULLs, so their places are hashed too; the second hash starts from another state.
    places = F.concat(F.lit(""), *[F.when(c.isNull(), "1").otherwise("0") for c in cells])
    marked = df.select(*[c.alias(f"_c{i}") for i, c in enumerate(cells)],
                       F.xxhash64(places, *cells).alias("_h1"),
                       F.xxhash64(F.lit(1), places, *cells).alias("_h2"),
                       _missing(df).alias("_missing"))
    # The count of NULLs follows from the row, so it is a third part of the fingerprint.
    mark = ["_h1", "_h2", "_missing"]
    seen = marked.groupBy(*mark).agg(F.count(F.lit(1)).alias("_n"))
    repeated = seen.filter(F.col("_n") > 1).select(*mark)
    # Grouped by the cells alone: rows are counted before they move again, and a hot row's
    # side of the join can be split.
    compared = (marked.join(repeated, mark, "left_semi")
                .groupBy(*[f"_c{i}" for i in range(len(cells))])
                .agg(F.count(F.lit(1)).alias("_n")))
    duplicates = compared.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint"))
    return (seen.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
                     F.lit(len(df.columns)).cast("bigint").alias("columns"),
                     F.coalesce(F.sum(F.col("_n") * F.col("_missing")), F.lit(0))
                     .cast("bigint").alias("missing_values"))
            .withColumn("duplicate_rows", duplicates.scalar()))


def duplicate_row_count(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier identical row."""
    return profile(df).select("duplicate_rows")


def row_counts(named: dict[str, DataFrame]) -> DataFrame:
    """SELECT 'name' AS TableName, COUNT(*) AS TotalRows ... UNION ALL ..."""
    parts = [df.agg(F.count(F.lit(1)).alias("TotalRows"))
             .select(F.lit(name).alias("TableName"), "TotalRows")
             for name, df in named.items()]
    return reduce(DataFrame.unionAll, parts)

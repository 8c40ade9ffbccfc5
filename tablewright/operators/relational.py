"""Table-changing statements and subquery forms of the SQL scripts, on DataFrames.

UPDATE / DELETE / INSERT change a stored table in the reference; here each
returns the new state as a DataFrame (S2, S18-S20). Subquery forms (P13-P15,
W5) are written so that no step gathers all rows into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


_TEMP: dict[tuple[int, str], DataFrame] = {}  # the cached contents of each temp table


def append_rows(df: DataFrame, new: DataFrame) -> DataFrame:
    """INSERT INTO t VALUES ... on a filled table (columns matched by name)."""
    return df.unionByName(new)


def update_where(df: DataFrame, cond: Column, assignments: dict[str, Column]) -> DataFrame:
    """UPDATE t SET c = v WHERE cond: rows where cond is unknown keep their values."""
    hit = F.coalesce(cond, F.lit(False))
    return df.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in assignments.items()})


def delete_where(df: DataFrame, cond: Column) -> DataFrame:
    """DELETE FROM t WHERE cond: rows where cond is unknown stay."""
    return df.filter(~F.coalesce(cond, F.lit(False)))


def with_scalar(df: DataFrame, source: DataFrame, agg: Column, name: str) -> DataFrame:
    """SELECT ..., (SELECT agg FROM source) AS name.

    Also the form of ``AGG(x) OVER ()`` on rows: Catalyst runs the one-row
    aggregate once as a subquery and inlines the value, instead of moving all
    rows into one task as an unpartitioned window would.
    """
    return df.withColumn(name, source.select(agg).scalar())


def semi_in(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """WHERE on IN (SELECT on FROM keys): a left semi join (no duplicates added)."""
    return df.join(keys.select(on).filter(F.col(on).isNotNull()), on, "left_semi")


def temp_table(df: DataFrame, name: str) -> DataFrame:
    """DROP TABLE IF EXISTS #name; CREATE ...; INSERT ... SELECT: a cached temp view.

    Re-registering replaces the previous contents, whose cache is released; a
    DataFrame returned earlier still gives its own contents, from its lineage.
    """
    old = _TEMP.pop((id(df.sparkSession), name), None)
    if old is not None:
        old.unpersist()
    _TEMP[id(df.sparkSession), name] = df.persist()
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def view(df: DataFrame, name: str) -> DataFrame:
    """CREATE OR ALTER VIEW name AS ...: a temp view (no data stored), then read it."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """UNION: duplicates removed, NULLs compare equal."""
    return a.unionByName(b).distinct()

"""Data-cleaning operators of the notebook.

Column-name work (C1, C8, C9, P20, P21) only touches the schema, on the
driver. Value work is JVM-side column expressions; the median fill is a
distributed exact median (no task holds a whole column).
"""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .stats import approx_medians, exact_medians

# Python's str.strip() removes every character for which str.isspace() holds.
PY_WHITESPACE = "".join(ch for ch in map(chr, range(sys.maxunicode + 1)) if ch.isspace())

# The notebook's column-name rewrites, in order.
NAME_REPLACEMENTS = [(" ", "_"), ("-", "_"), ("(", ""), (")", ""), ("/", "_"), ("²", "2"),
                     ("â²", "2"), ("Â²", "2"), ("â", "")]

# Cells that mean "missing": whole texts, matched exactly, and the
# number, matched in numeric columns only.
MISSING_TEXTS = ["unknown", "unkown", "Unknown", "-1", "nan"]
MISSING_NUMBER = -1

# What pandas reads as a number: decimal digits with sign, point and exponent, or an
# infinity; no type suffixes, no hexadecimal.
NUMBER = r"(?i)^[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?$|^[+-]?inf(inity)?$"

# A column is numeric if its name contains one of these.
NUMERIC_NAME_KEYWORDS = ["population", "area", "density", "growth", "percentage", "rank"]


def clean_column_name(name: str) -> str:
    """strip, lower, then the literal replacements in order."""
    out = name.strip().lower()
    for old, new in NAME_REPLACEMENTS:
        out = out.replace(old, new)
    return out


def clean_column_names(df: DataFrame) -> DataFrame:
    """Rename every column by position (names may repeat afterwards)."""
    return df.toDF(*[clean_column_name(c) for c in df.columns])


def q(name: str) -> Column:
    """A column by exact name, whatever characters it has."""
    return F.col(f"`{name}`")


def strip(c: Column) -> Column:
    """str.strip(): all Unicode whitespace off both ends; NULL stays NULL."""
    return F.btrim(c, F.lit(PY_WHITESPACE))


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def strip_text(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    cols = set(text_columns(df) if columns is None else columns)
    return df.select(*[strip(q(c)).alias(c) if c in cols else q(c) for c in df.columns])


def to_number(c: Column) -> Column:
    """pd.to_numeric(errors="coerce"): unparsable -> NULL, and NaN is NULL too."""
    text = strip(c.cast("string"))
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def coerce_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    cols = set(columns) & set(df.columns)
    return df.select(*[to_number(q(c)).alias(c) if c in cols else q(c) for c in df.columns])


def columns_with_keywords(df: DataFrame, keywords=NUMERIC_NAME_KEYWORDS) -> list[str]:
    return [c for c in df.columns if any(k in c for k in keywords)]


def is_missing_sentinel(c: Column, dtype: T.DataType) -> Column:
    """Text cells by their exact text, numbers by their value; other types have no sentinel."""
    if isinstance(dtype, T.StringType):
        return c.isin(MISSING_TEXTS)
    if isinstance(dtype, T.NumericType):
        return c == F.lit(MISSING_NUMBER)
    return F.lit(False)


def sentinels_to_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    cols = set(df.columns if columns is None else columns)
    return df.select(*[
        F.when(is_missing_sentinel(q(c), df.schema[c].dataType), F.lit(None).cast(df.schema[c].dataType))
        .otherwise(q(c)).alias(c) if c in cols else q(c) for c in df.columns])


def parse_currency(c: Column) -> Column:
    """Drop '$' and ',' then to number."""
    return to_number(F.replace(F.replace(c.cast("string"), F.lit("$"), F.lit("")),
                               F.lit(","), F.lit("")))


def merge_same_name(df: DataFrame) -> DataFrame:
    """``T.groupby(level=0).first().T``: columns sharing a name become one.

    The value is the first non-missing one in column order; the result's
    columns are sorted by name. Columns are addressed by position, so
    duplicate names never have to be resolved.
    """
    names = df.columns
    tmp = df.toDF(*[f"_c{i}" for i in range(len(names))])
    groups: dict[str, list[int]] = {}
    for i, n in enumerate(names):
        groups.setdefault(n, []).append(i)
    out = []
    for n in sorted(groups):
        idx = groups[n]
        col = F.col(f"_c{idx[0]}") if len(idx) == 1 else F.coalesce(
            *[F.col(f"_c{i}").cast("string") for i in idx])
        out.append(col.alias(n))
    return tmp.select(*out)


def merge_synonym(df: DataFrame, keep: str, other: str) -> DataFrame:
    """keep = keep.combine_first(other); drop other -- only if both exist."""
    if keep not in df.columns or other not in df.columns:
        return df
    return df.withColumn(keep, F.coalesce(q(keep), q(other))).drop(other)


def exact_median(df: DataFrame, column: str) -> DataFrame:
    """One row, one column ``median`` (see ``exact_medians``)."""
    return exact_medians(df, [column]).select(F.col(f"`{column}`").alias("median"))


def fill_median(df: DataFrame, columns: list[str] | None = None,
                approximate: bool = False) -> DataFrame:
    """Missing numbers -> the column's median (an all-missing column stays missing).

    Exact by default; ``approximate=True`` uses a bounded sketch instead.
    """
    cols = [c for c in df.columns if c in set(numeric_columns(df) if columns is None else columns)]
    if not cols:
        return df
    stats = approx_medians(df, cols) if approximate else exact_medians(df, cols)
    # One scalar subquery (a struct of all medians).
    medians = stats.select(
        F.struct(*[q(c).alias(f"m{i}") for i, c in enumerate(cols)])).scalar()
    return df.select(*[
        F.coalesce(q(c).cast("double"), medians.getField(f"m{cols.index(c)}")).alias(c)
        if c in cols else q(c) for c in df.columns])


def fill_text(df: DataFrame, values: dict[str, str]) -> DataFrame:
    """fillna for named text columns, only those present."""
    return df.select(*[F.coalesce(q(c), F.lit(values[c])).alias(c) if c in values else q(c)
                       for c in df.columns])


def missing_to_text(df: DataFrame, columns: list[str], value: str) -> DataFrame:
    """``replace("nan", NaN).fillna(value)`` on text columns."""
    cols = set(columns)
    return df.select(*[
        F.when(q(c).isNull() | (q(c) == "nan"), F.lit(value)).otherwise(q(c)).alias(c)
        if c in cols else q(c) for c in df.columns])

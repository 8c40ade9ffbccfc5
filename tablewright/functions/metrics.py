"""Report building blocks of the HR script: counts, rates, shares, bands.

Every rate is ``CAST(x * 100.0 / n AS DECIMAL(10,2))``: exact decimal
arithmetic, rounded half up, so thresholds run on the rounded value.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


# Band conditions and labels of the HR script, in CASE order.
AGE_BANDS = [
    ("Under 25", "<", 25),
    ("25-34", "between", (25, 34)),
    ("35-44", "between", (35, 44)),
    ("45-54", "between", (45, 54)),
    ("55 and Above", ">=", 55),
]
TENURE_BANDS = [
    ("Less than 1 Year", "<", 1),
    ("1-3 Years", "between", (1, 3)),
    ("4-6 Years", "between", (4, 6)),
    ("7-10 Years", "between", (7, 10)),
    ("More than 10 Years", ">", 10),
]
UNKNOWN_BAND = "Unknown"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def count_if(cond: Column) -> Column:
    """SUM(CASE WHEN cond THEN 1 ELSE 0 END): unknown counts as 0."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def sum_decimal(c: Column | str, scale: int = 2) -> Column:
    """SUM over a DECIMAL(p, s) expression, typed DECIMAL(38, s) as T-SQL types it."""
    return F.sum(col(c)).cast(f"decimal(38,{scale})")


# Floating means are reported to this many decimals (what the notebook shows);
# beyond that their last bits depend on the order rows were summed in.
FLOAT_DECIMALS = 6


def mean(c: Column | str) -> Column:
    return F.round(F.avg(col(c).cast("double")), FLOAT_DECIMALS)


def std(c: Column | str) -> Column:
    return F.round(F.stddev_samp(col(c).cast("double")), FLOAT_DECIMALS)


def pct(num: Column | str, den: Column | str) -> Column:
    """CAST(num * 100.0 / den AS DECIMAL(10,2))."""
    return (col(num) * F.lit(Decimal("100.0")) / col(den)).cast("decimal(10,2)")


def avg_dec(c: Column | str) -> Column:
    """CAST(AVG(CAST(c AS FLOAT)) AS DECIMAL(10,2)); NULLs skipped."""
    return F.avg(col(c).cast("double")).cast("decimal(10,2)")


def avg_int(name: str) -> Column:
    """AVG over an INT column in T-SQL: exact integer division of sum by count."""
    return F.expr(f"sum({name}) div count({name})").cast("int")


def share_of_total(count_col: str) -> Column:
    """COUNT(*) * 100.0 / SUM(COUNT(*)) OVER () on an aggregated frame.

    The window has no partition key, so it runs in one task: use it only on
    an aggregate, whose size is the number of groups, not of rows.
    """
    return pct(F.col(count_col), F.sum(count_col).over(Window.partitionBy()))


_OPS = {
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "between": lambda c, v: c.between(*v),
}


def band(c: Column | str, bands, unknown: str = UNKNOWN_BAND) -> Column:
    """Searched CASE over ``(label, op, value)`` in order; NULL falls to ``unknown``."""
    c = col(c)
    expr = None
    for label, op, value in bands:
        cond = _OPS[op](c, value)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(unknown)


def classify(c: Column | str, tiers, otherwise: str) -> Column:
    """First tier whose ``value >= threshold`` wins, else ``otherwise``."""
    c = col(c)
    expr = None
    for threshold, label in tiers:
        cond = c >= threshold
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(otherwise)

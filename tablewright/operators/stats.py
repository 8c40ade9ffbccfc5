"""Exact order statistics without gathering a column into one task.

Spark's exact ``percentile`` / ``median`` merge every distinct value of a group into one buffer,
and for a whole-table statistic that is one task. Here a sketch guides an exact selection:

1. one aggregate pass counts each column's values and takes a mergeable sketch of bounded size
   (``percentile_approx``), which gives a narrow *bracket* of values around every wanted position;
2. a second pass counts the values below each bracket and the values inside it, by value. Both are
   partial aggregates, so what is shuffled is some ``2 * MARGIN / ACCURACY`` of the distinct values;
3. the (at most two) values that cover a position are picked by a running count over the bracket.

The sketch only says where to look: a position outside of its bracket raises instead of giving
a wrong value. It is one lazy plan: no job runs when it is built, nothing is written or sorted whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.metrics import mean, std

#: The sketch's rank error is at most rows / ACCURACY; brackets are MARGIN times as wide to each side.
ACCURACY = 10_000
MARGIN = 8


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _present(name: str) -> Column:
    """The column as double; missing values (NULL, NaN) are NULL, as pandas skips them."""
    v = _q(name).cast("double")
    return F.when(~F.isnan(v), v)


def _brackets(df: DataFrame, columns: list[str], probs: list[float]) -> DataFrame:
    """(c, p, _total, _from, _to): a row per column and probability, whatever the size of ``df``."""
    reach = MARGIN / ACCURACY
    ends = [min(1.0, max(0.0, p + d)) for p in probs for d in (-reach, reach)]
    wide = df.agg(*[x for i, c in enumerate(columns) for x in (
        F.count(_present(c)).alias(f"n{i}"), F.percentile_approx(_present(c), ends, ACCURACY).alias(f"e{i}"))])
    cells = [F.struct(F.lit(c).alias("c"), F.lit(float(p)).alias("p"), F.col(f"n{i}").alias("_total"),
                      F.col(f"e{i}")[2 * k].alias("_from"), F.col(f"e{i}")[2 * k + 1].alias("_to"))
             for i, c in enumerate(columns) for k, p in enumerate(probs)]
    # So few rows are all inside: their positions lie closer together than the sketch's probabilities.
    few, inf = F.col("_total") <= ACCURACY, F.lit(float("inf"))
    return (wide.select(F.explode(F.array(*cells)).alias("r")).select("r.*").where("_total > 0")
            .withColumn("_from", F.when(few, -inf).otherwise(F.col("_from")))
            .withColumn("_to", F.when(few, inf).otherwise(F.col("_to"))))


def _values_at(df: DataFrame, columns: list[str], brackets: DataFrame) -> DataFrame:
    """(c, p, _frac, _vlo, _vhi): for each target row the values at positions ``_lo`` and ``_hi``."""
    t = brackets.withColumnRenamed("c", "_tc")
    long = (df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), _present(c).alias("v")) for c in columns])).alias("cv"))
            .select("cv.c", "cv.v").where("v IS NOT NULL"))
    # All values below a bracket count as one (NULL); those above it are left out.
    near = long.join(F.broadcast(t), (F.col("c") == F.col("_tc")) & (F.col("v") <= F.col("_to")))
    keys = ["c", "p", "_lo", "_hi", "_frac"]
    counts = near.groupBy(*keys, F.when(F.col("v") >= F.col("_from"), F.col("v")).alias("v")).agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy("c", "p").orderBy(F.col("v").asc_nulls_first())
                            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    counts = counts.withColumn("_end", upto)

    def covers(k):
        return F.col("v").isNotNull() & (F.col("_end") >= F.col(k)) & (F.col("_end") - F.col("_n") < F.col(k))

    found = (counts.groupBy("c", "p", "_frac")
             .agg(F.max(F.when(covers("_lo"), F.col("v"))).alias("_vlo"), F.max(F.when(covers("_hi"), F.col("v"))).alias("_vhi")))
    lost = F.col("_vlo").isNull() | F.col("_vhi").isNull()
    checked = F.when(lost, F.raise_error(F.lit("a position lies outside of its sketch's bracket")).cast("double"))
    return found.withColumn("_vlo", checked.otherwise(F.col("_vlo")))


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float]) -> DataFrame:
    """(c, p, value): linear interpolation between closest ranks, as pandas / Spark.

    Position h = 1 + (N - 1) p; value = v[floor h] + (h - floor h)(v[ceil h] - v[floor h]).
    """
    h = F.lit(1.0) + (F.col("_total") - 1) * F.col("p")
    targets = (_brackets(df, columns, probs).withColumn("_lo", F.floor(h)).withColumn("_hi", F.ceil(h))
               .withColumn("_frac", h - F.floor(h)))
    return _values_at(df, columns, targets).select(
        "c", "p", (F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * F.col("_frac")).alias("value"))


def exact_medians(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: pandas' median (mean of the two middle values) of each column.

    A column with only missing values gives NULL.
    """
    targets = (_brackets(df, columns, [0.5]).withColumn("_frac", F.lit(0.5))
               .withColumn("_lo", F.floor((F.col("_total") - 1) / 2) + 1)
               .withColumn("_hi", F.floor(F.col("_total") / 2) + 1))
    per_column = _values_at(df, columns, targets).select(
        "c", ((F.col("_vlo") + F.col("_vhi")) / 2).alias("m"))
    return per_column.agg(*[F.max(F.when(F.col("c") == c, F.col("m"))).alias(c)
                            for c in columns])


def approx_medians(df: DataFrame, columns: list[str], accuracy: int = 10000) -> DataFrame:
    """One row: approximate median of each column (opt-in for huge, high-cardinality data).

    ``percentile_approx`` keeps a mergeable sketch of bounded size per task, so
    this is one aggregate pass; the rank error is at most 1 / ``accuracy``.
    """
    return df.agg(*[F.percentile_approx(_q(c).cast("double"), 0.5, accuracy).alias(c)
                    for c in columns])


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df.describe()`` as rows: count, mean, std (n-1), min, 25/50/75 %, max per column.

    Moments in one aggregate pass; quartiles exact and distributed.
    """
    aggs = []
    for c in columns:
        v = _q(c).cast("double")
        aggs += [F.count(v).cast("double").alias(f"{c}__count"), mean(v).alias(f"{c}__mean"),
                 std(v).alias(f"{c}__std"), F.min(v).alias(f"{c}__min"),
                 F.max(v).alias(f"{c}__max")]
    wide = df.agg(*aggs)
    moments = wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"),
                 *[F.col(f"`{c}__{s}`").alias(s) for s in ("count", "mean", "std", "min", "max")])
        for c in columns])).alias("r")).select("r.*")
    quart = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    pivot = quart.groupBy(F.col("c").alias("column_name")).agg(
        *[F.max(F.when(F.col("p") == p, F.col("value"))).alias(name)
          for p, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))])
    return (moments.join(pivot, "column_name", "left")
            .select("column_name", "count", "mean", "std", "min", "p25", "p50", "p75", "max"))

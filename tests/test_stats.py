"""Distributed exact statistics against numpy on random data (ties, NULLs, NaN)."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tablewright.operators import stats as S
from tablewright.operators.rank import global_rank


def _data(seed, n):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        a = rnd.choice([None, float("nan"), rnd.randint(-5, 5), rnd.random() * 100])
        b = rnd.choice([None, rnd.randint(0, 3)])
        rows.append((i, None if a is None else float(a), None if b is None else float(b)))
    return rows


@pytest.mark.parametrize("seed,n", [(1, 1), (2, 2), (3, 57), (4, 400)])
def test_quantiles_and_medians_match_numpy(spark, seed, n):
    rows = _data(seed, n)
    df = spark.createDataFrame(rows, "id int, a double, b double").repartition(3)
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    got = {(r.c, r.p): r.value for r in S.exact_quantiles(df, ["a", "b"], probs).collect()}
    med = S.exact_medians(df, ["a", "b"]).first()
    for col, idx in (("a", 1), ("b", 2)):
        vals = np.array([r[idx] for r in rows if r[idx] is not None and not np.isnan(r[idx])])
        if len(vals) == 0:
            assert med[col] is None
            continue
        assert med[col] == pytest.approx(float(np.median(vals)), rel=1e-12, abs=1e-12)
        for p in probs:
            assert got[(col, p)] == pytest.approx(float(np.percentile(vals, p * 100)),
                                                  rel=1e-12, abs=1e-12)


@pytest.mark.parametrize("partitions", [1, 2, 50])
def test_rank_any_range_count(spark, partitions):
    rows = [(i, (i * 7) % 11 if i % 5 else None) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, k int")
    mine = global_rank(df, [("k", False)], "r", partitions=partitions)
    ref = df.withColumn("r", F.rank().over(Window.orderBy(F.col("k").asc())))
    assert sorted(mine.collect()) == sorted(ref.collect())


def test_brackets_are_narrow_and_no_job_runs_at_build(spark):
    rnd = random.Random(8)
    values = [rnd.gauss(0, 1) for _ in range(60_000)] + [0.25] * 20_000 + [None] * 500
    rnd.shuffle(values)
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "a double, i int").repartition(7)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("stats-build", "stats-build")
    quantiles, medians = S.exact_quantiles(df, ["a", "i"], [0.01, 0.5, 0.9]), S.exact_medians(df, ["a", "i"])
    assert list(tracker.getJobIdsForGroup("stats-build")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    got = {(r.c, r.p): r.value for r in quantiles.collect()}
    present = np.array([v for v in values if v is not None])
    for p in (0.01, 0.5, 0.9):
        assert got["a", p] == pytest.approx(np.percentile(present, 100 * p), abs=1e-12)
        assert got["i", p] == pytest.approx(np.percentile(np.arange(len(values)), 100 * p), abs=1e-9)
    assert medians.first()["a"] == np.median(present)
    b = S._brackets(df, ["i"], [0.5]).first()
    assert b["_to"] - b["_from"] < len(values) * 4 * S.MARGIN / S.ACCURACY


def test_a_position_outside_of_its_bracket_raises(spark, monkeypatch):
    df = spark.range(30_000).selectExpr("CAST(id AS DOUBLE) AS a")
    real = S._brackets
    monkeypatch.setattr(S, "_brackets", lambda *a: real(*a).selectExpr("c", "p", "_total", "_from + 1000 AS _from", "_to + 1000 AS _to"))
    with pytest.raises(Exception, match="outside of its"):
        S.exact_medians(df, ["a"]).collect()

"""The shuffle-friendly rank equals Spark's window RANK, ties and NULLs included."""

import random

import pytest

from pyspark.sql import Window
from pyspark.sql import functions as F

from tablewright.operators.rank import global_rank


def _data(spark):
    rnd = random.Random(7)
    rows = [(i, rnd.choice(["a", "b", None]), rnd.choice([1, 2, 2, 3, None, 7, 7, 7]))
            for i in range(2000)]
    return spark.createDataFrame(rows, "id int, p string, k int").repartition(5)


def test_global_rank_matches_window(spark):
    df = _data(spark)
    mine = global_rank(df, [("k", True)], "r", partitions=3)
    ref = df.withColumn("r", F.rank().over(Window.orderBy(F.col("k").desc())))
    assert sorted(mine.collect()) == sorted(ref.collect())


def test_partitioned_multi_key_rank_matches_window(spark):
    df = _data(spark)
    mine = global_rank(df, [("k", False), ("id", True)], "r", partition_by=["p"], partitions=4)
    w = Window.partitionBy("p").orderBy(F.col("k").asc(), F.col("id").desc())
    ref = df.withColumn("r", F.rank().over(w))
    assert sorted(mine.collect()) == sorted(ref.collect())


def test_rank_range_counts(spark):
    for seed, parts in ((11, 1), (12, 3), (13, 7), (14, 40)):
        rnd = random.Random(seed)
        rows = [(i, rnd.choice(["a", "b", "c", None]), rnd.choice([None, 1, 2, 2, 5, 9, 9, 9]),
                 rnd.randint(0, 3)) for i in range(700)]
        df = spark.createDataFrame(rows, "id int, p string, k int, j int").repartition(6)
        mine = global_rank(df, [("k", True), ("j", False)], "r", partition_by=["p"],
                           partitions=parts)
        w = Window.partitionBy("p").orderBy(F.col("k").desc(), F.col("j").asc())
        ref = df.withColumn("r", F.rank().over(w))
        assert sorted(mine.collect()) == sorted(ref.collect()), (seed, parts)


def _ranked_like_window(spark, df, order, part, parts):
    mine = global_rank(df, order, "r", partition_by=part, partitions=parts)
    w = Window.partitionBy(*part).orderBy(*[F.col(k).desc() if d else F.col(k).asc() for k, d in order])
    ref = df.withColumn("r", F.rank().over(w).cast("bigint"))
    assert mine.schema.fieldNames() == [*df.columns, "r"]
    assert sorted(mine.collect(), key=repr) == sorted(ref.collect(), key=repr)


def test_ties_over_borders_texts_dates_and_floats(spark):
    rnd = random.Random(21)
    rows = [(rnd.choice(["x", "", None, "é", "z" * 50]), f"2020-01-{rnd.randint(1, 28):02d}" if rnd.random() < .9 else None,
             rnd.choice([0.0, -0.0, 1.5, float("inf"), None])) for _ in range(1500)]
    df = spark.createDataFrame(rows, "`a b` string, d string, f double").withColumn("d", F.to_date("d")).repartition(7)
    for parts in (1, 2, 9):
        _ranked_like_window(spark, df, [("d", True), ("f", False)], [], parts)
    _ranked_like_window(spark, df.withColumnRenamed("a b", "p"), [("f", True)], ["p", "d"], 5)


def test_one_key_one_row_no_rows(spark):
    df = spark.createDataFrame([(1, "a")] * 300, "k int, p string").repartition(4)
    _ranked_like_window(spark, df, [("k", True)], ["p"], 4)
    _ranked_like_window(spark, df.limit(1), [("k", True)], [], 4)
    _ranked_like_window(spark, df.limit(0), [("k", True)], ["p"], 4)


def test_rank_is_lazy_and_splits_a_hot_key(spark):
    df = spark.range(0, 30_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"), F.lit("p").alias("p"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("rank-build", "")
    mine = global_rank(df, [("k", False)], "r", partition_by=["p"], partitions=8)
    assert list(tracker.getJobIdsForGroup("rank-build")) == []
    spark.sparkContext.setJobGroup("rank-run", "")
    text = mine._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in text and "Window [" in text
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = (mine.where("k = 7").groupBy(F.spark_partition_id().alias("t")).count().collect())
        assert len(tasks) > 1
        assert max(r["count"] for r in mine.groupBy(F.spark_partition_id()).count().collect()) < 15_000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")

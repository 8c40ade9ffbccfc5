"""Repeated ids, weights of 0, invalid UTF-8 and carried columns."""

import random

from pyspark.sql import functions as F

from tablewright.llm import bpe, host_quality, mixing, toxicity
from tablewright.llm.common import BATCH_BYTES, bounded_batches


def test_weight_of_zero_takes_nothing(spark):
    rows = [(i, d, lang, s, 10 * (i + 1)) for i, (d, lang, s) in enumerate(
        [("a", "en", "x"), ("a", "en", "y"), ("a", "de", "z"), ("b", "en", "u"), ("b", "fr", "v")])]
    supply = spark.createDataFrame([r[1:] for r in rows], "domain string, lang string, source string, supply long")

    def alloc(weights):
        return {r["source"]: r["alloc"] for r in mixing.budgets(supply, weights, 60).collect()}

    whole = 60 * sum(r[4] for r in rows) // 100
    none = {"domain": {}, "lang": {}, "source": {}}
    got = alloc(none | {"source": {"x": 0}})
    assert got["x"] == 0 and whole - 6 <= sum(got.values()) <= whole
    got = alloc(none | {"domain": {"a": 0}})
    assert got["x"] == got["y"] == got["z"] == 0 and got["u"] + got["v"] > 0
    got = alloc(none | {"domain": {"a": 0, "b": 0}})
    assert set(got.values()) == {0}


def test_model_of_repeated_ids_does_not_depend_on_partitions(spark):
    rng = random.Random(4)
    words = [f"w{k}" for k in range(60)]
    rows = [(k % 150, " ".join(rng.choices(words, k=30) + (["awful"] * 2 if k % 150 % 3 == 0 else []))) for k in range(400)]
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(150)], "doc_id long, toxic int")
    models = []
    for parts in (1, 5):
        rng.shuffle(rows)
        models.append(toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts), labels))
    assert models[0] == models[1]


def test_invalid_utf8_has_one_rule(spark):
    raw = b"good \xff\xfe text \xc3"
    df = spark.createDataFrame([(1, raw)], "doc_id long, b binary").select("doc_id", F.col("b").cast("string").alias("text"))
    same = spark.createDataFrame([(1, raw.decode("utf-8", "replace"))], "doc_id long, text string")
    assert bpe.encode(df, lexicon_words=10).collect() == bpe.encode(same, lexicon_words=10).collect()
    assert host_quality.measures(raw)[:2] == (4, 11)  # 4 + 2 + 4 + 1 characters


def test_batches_are_bounded(spark):
    old = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    try:
        bounded_batches(spark)
        assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == f"{BATCH_BYTES}b"
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "1m")
        bounded_batches(spark)
        assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") in ("1m", "1048576b", "1048576")
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", old)

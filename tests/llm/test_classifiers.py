"""Toxicity and quality classifiers: held-out accuracy, the model's formula, edge rows."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.llm import toxicity, weak_quality

SF = "/root/testdata/sf0.01"


# --- toxicity ---------------------------------------------------------------------------------

def test_margin_is_the_sum_over_pairs():
    rng = np.random.default_rng(1)
    w, v = rng.standard_normal(30), rng.standard_normal((30, toxicity.FACTORS))
    rows = [[], [3], [1, 4, 9], list(range(20))]
    offsets = np.cumsum([0] + [len(r) for r in rows])
    z, _ = toxicity.margins(offsets, np.array([c for r in rows for c in r], np.int64), 0.5, w, v)
    for row, got in zip(rows, z):
        want = 0.5 + sum(w[i] for i in row) + sum(v[i] @ v[j] for k, i in enumerate(row) for j in row[:k])
        assert abs(got - want) < 1e-9


def test_pairs_are_learnt():
    """Toxic only if both words are there: no sum of single weights says so."""
    rng = np.random.default_rng(2)
    rows, y = [], []
    for _ in range(3000):
        a, b = rng.random(2) < 0.5
        rows.append(sorted([0] * int(a) + [1] * int(b) + rng.choice(np.arange(2, 60), 6, replace=False).tolist()))
        y.append(float(a and b))
    offsets = np.cumsum([0] + [len(r) for r in rows])
    columns, y = np.array([c for r in rows for c in r], np.int64), np.array(y)
    kept = toxicity.informative(offsets, columns, y, 60)
    assert {0, 1} <= set(kept.tolist()) and len(kept) < 10
    bias, w, v = toxicity.train(offsets, columns, y, np.ones(len(y)), 60)
    one = lambda *c: 1 / (1 + np.exp(-toxicity.margins(np.array([0, len(c)]), np.array(c, np.int64), bias, w, v)[0][0]))
    assert one(0, 1) > 0.7 and one(0) < 0.3 and one(1) < 0.3 and one() < 0.3


def test_pairs_of_neutral_terms_among_thousands_are_learnt(spark):
    """Toxic if exactly one of two words is there; each alone is as frequent in both classes."""
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("abcdefghijklmnop"), 7)) for _ in range(3000)]
    docs, labels = [], []
    for i in range(4000):
        a, b = rng.random(2) < 0.5
        docs.append((i, " ".join(["zzalpha"] * int(a) + ["qqbeta"] * int(b) + rng.choice(words, 40).tolist())))
        labels.append((i, int(a != b)))
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = toxicity.score(docs, model).where("held_out").collect()
    assert np.mean([r["predicted"] == labels[r["doc_id"]][1] for r in got]) > 0.95


def test_pairs_are_all_tested():
    """The pair search against every pair counted one by one."""
    rng = np.random.default_rng(5)
    rows = [np.flatnonzero(rng.random(50) < 0.3) for _ in range(600)]
    y = np.array([float((3 in r) == (7 in r)) if rng.random() < 0.9 else float(rng.random() < 0.5) for r in rows])
    offsets, columns = np.cumsum([0] + [len(r) for r in rows]), np.concatenate(rows)
    has = np.zeros((600, 50), bool)
    for i, r in enumerate(rows):
        has[i, r] = True
    want, least = set(), np.log(50 * 50 / toxicity.CHANCE)
    for a in range(50):
        for b in range(a):
            both = has[:, a] & has[:, b]
            k, n = y[both].sum(), both.sum()
            if min(toxicity.evidence(k, n, p) for p in (y[has[:, a]].mean(), y[has[:, b]].mean(), 0.5)) >= least:
                want |= {a, b}
    for toxicity_dense in (toxicity.DENSE, 0, 9):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(toxicity, "DENSE", toxicity_dense)
            assert set(toxicity.interacting(offsets, columns, y, np.full(600, 0.5), 50).tolist()) == want == {3, 7}


@pytest.fixture(scope="module")
def scored(spark):
    return toxicity.query(spark, SF).toPandas()


def test_held_out_accuracy(spark, scored):
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas().merge(scored, on="doc_id")
    test = labels[labels.held_out]
    assert (test.predicted == test.toxic).mean() > 0.94 and scored.score.between(0, 1).all()
    texts = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").toPandas().merge(scored, on="doc_id")
    insult = texts.text.str.contains(r"\b(?:idiot|moron|scum)\b")
    assert texts[insult].predicted.mean() > 0.9
    assert (scored.held_out == scored.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 3 == 1)).all()


def test_scores_don_t_see_labels_of_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.fit(docs, labels) == toxicity.fit(docs.repartition(3), flipped)


def test_toxicity_edge_rows(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1)], "doc_id long, toxic int")
    rows = [(1, None, "a"), (2, "", "b"), (2, "", "b"), (None, "x " * 30_000, "c"), (3, "É" * 9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    assert len(got) == 5 and all(0 <= r["score"] <= 1 for r in got)
    assert not any(r["held_out"] for r in got if r["doc_id"] is None)
    none = toxicity.score(docs.limit(0), toxicity.fit(docs.limit(0), labels.limit(0)))
    assert none.collect() == []


# --- quality ----------------------------------------------------------------------------------

def test_em_finds_the_accuracies():
    """Votes drawn from known tables; the posterior recovers the hidden class."""
    rng = random.Random(3)
    m = len(weak_quality.LABELLERS)
    counts, truth = {}, []
    for _ in range(20_000):
        good = rng.random() < 0.8
        pattern = 0
        for k in range(m):
            vote = rng.choices([0, 1, 2], [0.3, 0.69, 0.01] if good else [0.3, 0.4, 0.3])[0]
            pattern = pattern * 3 + vote
        counts[pattern] = counts.get(pattern, 0) + 1
        truth.append((pattern, good))
    posterior, share = weak_quality.maximise(counts)
    assert abs(share - 0.8) < 0.08  # the prior on the votes pulls a little
    assert np.mean([(posterior[p] >= 0.5) == g for p, g in truth]) > 0.93
    assert weak_quality.maximise({}) == ({}, 1.0)


def test_em_tells_labellers_apart_where_junk_is_rare():
    """Three labellers know 2 % junk, six know nothing; the prior doesn't grow with the table."""
    rng = random.Random(3)
    counts, junk = {}, []
    for _ in range(20_000):
        good = rng.random() < 0.98
        pattern = 0
        for k in range(len(weak_quality.LABELLERS)):
            knows = k < 3 and not good
            pattern = pattern * 3 + rng.choices([0, 1, 2], [0.3, 0.2, 0.5] if knows else [0.3, 0.69, 0.01])[0]
        counts[pattern] = counts.get(pattern, 0) + 1
        if not good:
            junk.append(pattern)
    posterior, _ = weak_quality.maximise(counts)
    assert np.mean([posterior[p] < 0.5 for p in junk]) > 0.62


def test_quality_against_labels(spark):
    for sf, least in (("/root/testdata/sf0.001", 0.95), (SF, 0.98)):
        got = weak_quality.query(spark, sf).toPandas()
        both = spark.read.parquet(f"{sf}/labels.parquet").toPandas().merge(got, on="doc_id")
        assert ((both.quality == 1) == both.kept).mean() > least
        assert both[both.quality == 1].kept.mean() > 0.99  # clean documents stay


def test_quality_edge_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(None, "a b"), (7, None), (8, ""), (9, "w " * 50_000), (9, "w " * 50_000)], docs.schema)
    whole = docs.unionByName(odd).withColumn("score", F.lit("mine")).withColumn("kept", F.lit(1))
    kept = weak_quality.keep_documents(whole)
    assert kept.columns == whole.columns and 0 < kept.count() < whole.count()
    assert weak_quality.keep_documents(whole.limit(0)).collect() == []
    same = spark.createDataFrame([(i, "only one kind of text " * 20) for i in range(50)], docs.schema)
    assert weak_quality.keep_documents(same).count() in (0, 50)

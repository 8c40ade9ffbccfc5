"""The pipeline stage by stage against brute-force versions, on the small documents."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tablewright.llm import bpe, jaccard_join, mixing
from tests.llm.test_filters import measures
from tests.llm.test_jaccard_join import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """[(name, input rows, output rows)] of a run over the documents and some odd rows."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = docs.limit(3).unionByName(docs.limit(1).withColumn("doc_id", F.lit(None).cast("long")))
    odd = odd.unionByName(docs.limit(1).withColumns({"doc_id": F.lit(10**6), "text": F.lit(None).cast("string"),
                                                     "lang": F.lit(None).cast("string")}))
    docs = docs.unionByName(odd)
    out, root = [], tmp_path_factory.mktemp("pipeline")
    for name, stage in corpus_pipeline.STAGES:
        path = str(root / name)
        stage(spark, docs, SF).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((name, docs.collect(), after.collect(), docs.columns, after.columns))
        docs = after
    return {name: rest for name, *rest in out}


def test_columns_and_subsets(stages):
    names = [n for n, _ in corpus_pipeline.STAGES]
    for name in names[:-1]:
        before, after, columns, kept = stages[name]
        assert kept == columns and after
        if name != "source_mix":
            assert not Counter(after) - Counter(before)


def test_classifier_keeps_good_documents(stages, spark):
    before, after, *_ = stages["quality_classifier"]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in after}
    right = [(labels[r["doc_id"]] == 1) == (r["doc_id"] in kept) for r in before if r["doc_id"] in labels]
    assert sum(right) >= 0.97 * len(right)
    assert len([r for r in before if labels.get(r["doc_id"]) == 1 and r["doc_id"] not in kept]) <= 2


def test_rules(stages):
    before, after, *_ = stages["quality_rules"]
    failed = lambda m: m[0] < 50 or 100 * m[4] > 50 * m[0]
    assert Counter(after) == Counter(r for r in before if not failed(measures(r["text"])))  # no host is bad here


def test_one_of_each_group_stays(stages):
    before, after, *_ = stages["near_duplicates"]
    component = {i: c for i, _, c in brute([(r["doc_id"], r["text"]) for r in before])}
    assert Counter(r["doc_id"] for r in after if r["doc_id"] is not None) == Counter({c: 1 for c in component.values() if c is not None})
    assert sum(r["doc_id"] is None for r in after) == sum(r["doc_id"] is None for r in before)


def test_mix_and_tokens(stages, spark):
    before, after, columns, _ = stages["source_mix"]
    again = mixing.mix_documents(spark.createDataFrame(before, "doc_id long, text string, lang string, source string, n_chars long"))
    assert Counter(r["doc_id"] for r in after) == Counter(r["doc_id"] for r in again.collect())
    words = lambda rows: sum(len((r["text"] or "").split()) for r in rows)
    assert words(before) * 0.95 <= words(after) <= words(before) * 1.2
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(bpe.tokenizer_path())
    docs, tokens, *_ = stages["tokens"]
    want = Counter((r["doc_id"], len(library.encode(r["text"] or "", add_special_tokens=False).ids)) for r in docs)
    assert Counter((r["doc_id"], r["n_tokens"]) for r in tokens) == want


def test_keep_one_with_shared_ids(spark):
    a = "one two three four five six seven eight nine ten"
    rows = [(1, a), (1, a), (1, "else"), (2, a), (3, "x y z"), (None, a), (None, a), (4, None), (4, ""), (4, " "), (5, a), (5, "other b")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r["doc_id"], r["text"]) for r in jaccard_join.keep_one(df).collect())
    assert got == Counter({(1, a): 1, (1, "else"): 1, (3, "x y z"): 1, (4, None): 1, (4, ""): 1, (4, " "): 1, (None, a): 2,
                           (5, "other b"): 1})


@pytest.mark.parametrize("limit", [1 << 24, 0])
def test_ids_by_filter_or_by_join(spark, monkeypatch, limit):
    monkeypatch.setattr(jaccard_join, "BLOOM_IDS", limit)
    a, b = (" ".join(f"{x}{k}" for k in range(60)) for x in "ab")
    rows = [(k, f"{a} t{k}" if k % 2 else f"{b} t{k}") for k in range(40)]
    got = jaccard_join.join_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {(r["doc_id"], r["component_id"]) for r in got} == {(k, k % 2) for k in range(40)}


def test_run_on_documents_and_empty_table(spark, tmp_path):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 100
    spark.read.parquet(f"{SF}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []

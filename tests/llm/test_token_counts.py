"""Edited counts against encoding the whole edited text."""

import hashlib
import random

import pytest

from tablewright.llm import token_counts as tc

PATH, PATTERN = tc.tokenizer_path(), tc.token_pattern()


@pytest.fixture(scope="module")
def counter():
    return tc.Counter(PATH, PATTERN)


def edited(text, edits):
    for position, remove, put in edits:
        position = len(text) if position is None else max(0, min(position, len(text)))
        text = text[:position] + (put or "") + text[position + max(0, remove or 0):]
    return text


def bits(rng, n):
    return "".join(rng.choice(["word", " ", "  ", "\n", "'re", "'", "r", "e", "12", "é", "!?", "\t ", "ß", "日本", "'l", "l"])
                   for _ in range(n))


def test_edits_equal_a_fresh_count(counter):
    rng = random.Random(8)
    for trial in range(300):
        text = bits(rng, rng.choice([0, 3, 30, 400, 2000]))
        tree = tc.Tree(counter, text)
        for _ in range(rng.randrange(1, 12)):
            edit = (rng.randrange(-2, len(text) + 5), rng.choice([0, 0, 1, 5, 300, 10_000]), bits(rng, rng.choice([0, 1, 2, 40, 900])))
            text = edited(text, [edit])
            tree.edit(*edit)
            assert tree.text == text and tree.n_tokens == len(counter.encode(text)), (trial, edit)
        fresh = tc.Tree(counter, text)
        assert (tree.n_tokens, tree.chars[1]) == (fresh.n_tokens, fresh.chars[1])


def test_a_small_edit_encodes_little(counter):
    text = "some words in a row " * 5000
    tree = tc.Tree(counter, text)
    tree.edit(50_000, 3, "other")
    assert tree.encoded < 1000 and tree.n_tokens == len(counter.encode(tree.text))


def test_rows_and_tables_agree(spark, counter):
    rng = random.Random(1)
    docs = [(i, bits(rng, rng.choice([0, 10, 300]))) for i in range(40)] + [(40, None), (41, ""), (7, "same id"), (None, "no id")]
    edits = [(rng.randrange(45), k, rng.choice([None, rng.randrange(0, 500)]), rng.choice([None, 0, 3]), rng.choice([None, " x", "yz"]))
             for k in range(120)] + [(3, 1000 + k, k, 1, "hot") for k in range(400)] + [(None, 1, 0, 0, "lost")]
    df = spark.createDataFrame([(i, t, 5) for i, t in docs], "doc_id long, text string, kind int")
    ef = spark.createDataFrame(edits, "doc_id long, seq int, position int, remove int, put string")
    got = sorted(((r["doc_id"], r["n_tokens_before"], r["n_tokens"], r["n_edits"], r["text"], r["text_sha256"])
                  for r in tc.apply_edits(df, ef, full=True).collect()), key=str)
    want = []
    for i, t in docs:
        own = sorted([e for e in edits if i is not None and e[0] == i], key=lambda e: e[1])
        text = edited(t or "", [(p, n, x) for _, _, p, n, x in own])
        want.append((i, len(counter.encode(t or "")), len(counter.encode(text)), len(own), text,
                     hashlib.sha256(text.encode()).hexdigest()))
    assert got == sorted(want, key=str)


def test_query_equals_full_encoding(spark, counter):
    sf = "/root/testdata/sf0.001"
    from pyspark.sql import functions as F
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.select("doc_id", "text", tc.sample_edits(F.col("doc_id"), F.col("text")).alias("e")).collect()}
    got = tc.query(spark, sf).collect()
    assert len(got) == len(rows)
    for r in got:
        row = rows[r["doc_id"]]
        text = edited(row["text"], [(e["position"], e["remove"], e["put"]) for e in row["e"]])
        assert r["n_tokens"] == len(counter.encode(text)) and r["n_chars"] == len(text)
        assert r["n_tokens_before"] == len(counter.encode(row["text"]))
        assert r["text_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    ef = spark.createDataFrame([], "doc_id long, seq int, position int, remove int, put string")
    assert tc.apply_edits(df, ef).collect() == []

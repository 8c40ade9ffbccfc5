"""Substring dedup against plain windows."""

import hashlib
import random
import re

import duckdb
import numpy as np
import pytest

from tablewright.llm import substring_dedup as sd

SF = "/root/testdata/sf0.001"


def brute(rows, window=sd.WINDOW):
    """[(id, n_words, n_removed, sha)] of rows (id, text)."""
    texts = [(sd.LAST_ID if i is None else i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    lead = {}
    for i, words in texts:
        for p in range(len(words) - window + 1):
            key = tuple(words[p:p + window])
            lead[key] = min(lead.get(key, (i, p)), (i, p))
    out = []
    for (given, _), (i, words) in zip(rows, texts):
        gone = set()
        for p in range(len(words) - window + 1):
            if lead[tuple(words[p:p + window])] < (i, p):
                gone.update(range(p, p + window))
        kept = [w for p, w in enumerate(words) if p not in gone]
        out.append((given, len(words), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def texts():
    rng = random.Random(17)
    word = lambda: rng.choice("abcdéfgh") + str(rng.randrange(300))
    some = lambda n: [word() for _ in range(n)]
    rows = []
    passages = [some(n) for n in (19, 20, 21, 33, 60, 200)]
    line = some(8)
    for k in range(120):
        words = some(rng.randrange(0, 40))
        for _ in range(rng.randrange(0, 3)):
            p = rng.choice(passages)
            a = rng.randrange(0, max(1, len(p) - 15))
            words += p[a:a + rng.randrange(10, 70)] + some(rng.randrange(0, 12))
        if k % 4 == 0:  # one anchor among ever other words
            words += some(11) + line + some(11) + line
        rows.append((k, " ".join(words)))
    rows += [(200 + k, rows[k % 7][1]) for k in range(30)]  # copies
    rows += [(300, "la " * 100), (301, "la " * 25 + "lo " + "la " * 30), (302, "la lo " * 60), (303, "a b c d e f g " * 40)]
    rows += [(400, None), (401, ""), (402, " \t\n\x0b"), (403, " ".join(some(19))), (404, "\n".join(passages[5]))]
    rows += [(None, " ".join(passages[4])), (None, " ".join(passages[4] + some(4))), (None, None), (5, rows[6][1]),
             (5, rows[6][1]), (5, " ".join(passages[5])), (500, " ".join(some(6000) + passages[5] + some(6000)))]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("gather,seed,parts", [(1_000_000, 8, 1), (50, 8, 5), (400, 3, 7)])
def test_equal_to_brute_force(spark, monkeypatch, gather, seed, parts):
    monkeypatch.setattr(sd, "GATHER", gather)
    rows = texts()
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, place int, code string")
    got = sd.dedup_substrings(df.repartition(parts), seed=seed).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_kept_text_and_maximal_repeats(spark):
    rng = random.Random(2)
    a, b = ([str(rng.random()) for _ in range(n)] for n in (50, 70))
    rows = [(1, " ".join(a)), (2, " ".join(b[:30] + a[5:45] + b[30:]))]
    out = {r["doc_id"]: r for r in sd.dedup_substrings(spark.createDataFrame(rows, "doc_id int, text string"), full=True).collect()}
    assert out[1]["repeats"] == [] and out[1]["kept"].decode() == rows[0][1]
    assert [tuple(r) for r in out[2]["repeats"]] == [(30, 70)] and out[2]["kept"].decode() == " ".join(b)


def test_sql_and_given_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted(map(tuple, sd.query(spark, SF).collect()), key=str)
    assert got == brute(rows)
    odd = texts()
    con = duckdb.connect()
    con.register("documents", spark.createDataFrame(odd, "doc_id long, text string").toArrow())
    assert sorted(con.sql(sd.SQL).select("doc_id, n_words, n_removed, kept_sha256").fetchall(), key=str) == brute(odd)


def test_equal_windows_choose_one_anchor():
    rng = np.random.default_rng(6)
    for high in (3, 1 << 60):  # many ties, and none
        codes = rng.integers(0, high, 300).astype(np.uint64)
        place, first, last = sd.anchors(codes)
        assert first[0] == 0 and last[-1] == len(codes) - 13 and (first[1:] == last[:-1] + 1).all()
        for p, a, b in zip(place, first, last):
            for w in (a, b):
                part = codes[w:w + 13]
                assert p - w == 12 - int(np.argmin(part[::-1]))


def test_not_utf8_and_empty(spark):
    words = b" ".join(b"\xff%d" % k for k in range(40))
    df = spark.createDataFrame([(1, words), (2, words)], "doc_id long, text binary")
    got = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in sd.dedup_substrings(
        df.selectExpr("doc_id", "CAST(text AS STRING) AS text")).collect()}
    assert got == {1: (40, 0), 2: (40, 40)}
    assert sd.dedup_substrings(spark.createDataFrame([], "doc_id long, text string")).collect() == []

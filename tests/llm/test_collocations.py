"""Collocations against counting every phrase as a text."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from tablewright.llm import collocations as co

SF = "/root/testdata/sf0.001"


def brute(rows, least=co.LEAST, top=co.TOP):
    """[(lang, rank, phrase, a, l, r, n, score)] of rows (text, lang)."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                f.update((lang, tuple(words[i:i + k])) for i in range(len(words) - k + 1))
    cand = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    inside = {}
    for (lang, p), a in cand.items():
        for m in range(2, len(p)):
            for i in range(len(p) - m + 1):
                key = lang, p[i:i + m]
                inside[key] = max(inside.get(key, 0), a)
    found = {}
    for (lang, p), a in cand.items():
        if 100 * inside.get((lang, p), 0) >= 80 * a:
            continue
        cuts = [(2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p))]
        score, _, left, right = min(cuts)
        found.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right))
    return sorted((lang, r, p.decode(), -a, left, right, n[lang], -score) for lang, rows in found.items()
                  for r, (score, a, p, left, right) in enumerate(sorted(rows)[:top], 1))


def texts():
    rng = random.Random(23)
    words = ["the", "The", "of", "new", "york", "city", "hall", "à", "ß", "x-y", "(a)", "'", "la"] + [f"w{k}" for k in range(40)]
    rows = []
    for k in range(400):
        parts = []
        for _ in range(rng.randrange(0, 12)):
            part = [rng.choice(words) for _ in range(rng.randrange(0, 9))]
            if rng.random() < 0.3:
                part += ["New", "York", "city"][:rng.randrange(2, 4)] + (["hall"] if rng.random() < 0.9 else [])
            parts.append(rng.choice([" ", "\t", "  "]).join(part))
        rows.append(("".join(p + rng.choice([". ", ", ", "\n", "!", "\r\n", ";:"]) for p in parts), rng.choice(["en", "de", None, "und"])))
    rows += [(None, "en"), ("", "de"), (".,;", "fr"), (" \t\n", None), ("la " * 3000, "es"), ("only one. time", "it"), ("la " * 40, "la")]
    return rows


@pytest.mark.parametrize("gather,size,top,parts", [(10**6, 12_000_000, 2000, 2), (300, 3_000, 7, 5), (5_000, 500, 40, 3)])
def test_equal_to_brute_force(spark, monkeypatch, gather, size, top, parts):
    monkeypatch.setattr(co, "GATHER", gather)
    monkeypatch.setattr(co, "SLICE_BYTES", size)
    rows = texts()
    df = spark.createDataFrame([(t, lang, 1, "x") for t, lang in rows], "text string, lang string, n int, h1 string")
    got = co.collocations(df.repartition(parts), least=6, top=top).collect()
    want = brute(rows, 6, top)
    assert len(want) > 60 or top < 2000
    assert sorted(map(tuple, got)) == want


def test_sql_and_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["text"], r["lang"]) for r in docs.collect()]
    assert sorted(map(tuple, co.query(spark, SF).collect())) == brute(rows)
    con = duckdb.connect()
    odd = texts()
    con.register("documents", spark.createDataFrame(odd, "text string, lang string").toArrow())
    assert sorted(con.sql(co.SQL).select("lang, rank, phrase, a, l, r, n, score").fetchall()) == brute(odd)


def test_blocks_keep_their_records():
    rng = np.random.default_rng(4)
    for high in (50, 70_000):
        codes = rng.integers(0, high, 90_000).astype(np.uint64)
        known, lanes = co.records(codes)
        lanes, counts = co.summed(known, lanes, np.ones(len(lanes[0]), np.int64))
        assert counts.sum() == (codes > 0).sum()
        names = {r: b"w%d" % known[r] for r in np.unique(lanes[0]).tolist()}
        back, back_lanes, back_counts, first, text = co.unpacked(co.packed(known, lanes, counts, names))
        assert all((back[a] == known[b]).all() for a, b in zip(back_lanes, lanes)) and (back_counts == counts).all()
        assert [b"w%d" % c for c in first] == text.split(b" ")
        at = 1234
        border = tuple(int(known[lane[at]]) for lane in lanes)
        assert co.cut_at(known, lanes, border) == at
        assert co.cut_at(known, lanes, (border[0], 1 << 62, 0, 0)) == np.searchsorted(lanes[0], lanes[0][at], "right")


def test_empty_and_not_utf8(spark):
    assert co.collocations(spark.createDataFrame([], "text string, lang string")).collect() == []
    df = spark.createDataFrame([(b"a\xff b\xfe. " * 30, "en")], "text binary, lang string")
    got = co.collocations(df.selectExpr("CAST(text AS STRING) AS text", "lang")).selectExpr("a", "l", "n", "octet_length(phrase) AS s").collect()
    assert [tuple(r) for r in got] == [(30, 30, 60, 5)]

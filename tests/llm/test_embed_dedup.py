"""Vector links against brute force; components against union-find."""

import random

import numpy as np

from tablewright.llm import embed_dedup
from tablewright.llm.components import connected_components
from tests.llm.graphs import roots_of


def brute(rows, threshold=0.95):
    """[(id, n_links, component, kept)]"""
    good = []
    for k, (_, v) in enumerate(rows):
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, np.float64)
            good.append((k, x / np.linalg.norm(x)))
    links = {k: [j for j, y in good if j != k and len(x) == len(y) and x @ y >= threshold] for k, x in good}
    edges = [(rows[k][0], rows[j][0]) for k in links for j in links[k]]
    root = roots_of([r[0] for r in rows], edges)
    return sorted((i, len(links.get(k, [])), root[i], root[i] == i) for k, (i, _) in enumerate(rows))


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    edges += [(1000 + i, 1001 + i) for i in range(40)] + [(5000, 5000 + i) for i in range(1, 60)] + [(7, None)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["component"] for r in connected_components(df).collect()}
    whole = [e for e in edges if None not in e]
    want = roots_of({x for e in whole for x in e}, whole)
    assert got == {n: c for n, c in want.items() if n != c}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def vectors():
    rng = np.random.default_rng(0)
    rows, n = [], 0
    for size in (1, 1, 2, 3, 8, 60, 150):
        centre = rng.standard_normal(16)
        for _ in range(size):
            rows.append((n, (centre + rng.standard_normal(16) * 0.22 * np.linalg.norm(centre) / 4).tolist()))
            n += 1
    same = rng.standard_normal(16).tolist()
    rows += [(n + k, same) for k in range(40)]
    n += 40
    rows += [(n, None), (n + 1, []), (n + 2, [0.0] * 16), (n + 3, [float("nan")] * 16), (n + 4, [1.0, 2.0]),
             (n + 5, [2.0, 4.0]), (n + 6, [float("inf")] + [1.0] * 15), (n + 7, [1e300] * 16), (n + 8, [1.0] * 16)]
    return rows


def test_links_equal_brute_force(spark):
    rows = vectors()
    df = spark.createDataFrame([(i, v, 9, "x") for i, v in rows], "vec_id long, embedding array<double>, k1 int, rep string")
    for block in (16, 2048):
        got = sorted(tuple(r) for r in embed_dedup.link_vectors(df, miss=1e-9, block=block).collect())
        assert got == brute([r if r[1] is None or len(r[1]) != 16 or r[1][0] != 1e300 else (r[0], [1.0] * 16) for r in rows])


def test_query_recall(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = sorted(tuple(r) for r in embed_dedup.query(spark, sf).collect())
    want = brute(rows)
    found, there = sum(r[1] for r in got), sum(r[1] for r in want)
    assert found == there and got == want  # these tables hold no links
    rows = vectors()  # default parameters: recall against brute force
    df = spark.createDataFrame([r for r in rows if r[1] != [1e300] * 16], "vec_id long, embedding array<double>")
    got, want = [sum(r[1] for r in x) for x in (embed_dedup.link_vectors(df).collect(), brute(rows))]
    assert 0.99 * want <= got <= want


def test_empty(spark):
    assert embed_dedup.link_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []

"""Progressive search and clustering against plain distances."""

import hashlib
import random

import duckdb
import numpy as np
import pytest

from tablewright.llm import centroid_cluster as cc


def brute(rows, clusters=cc.CLUSTERS, rounds=cc.ROUNDS, seed=cc.SEED):
    """[(vec_id, cluster, distance, cluster_inertia, inertia, sha)] in Python integers."""
    from math import floor, isfinite
    kept = [(i, [floor(cc.SCALE * x) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and isfinite(x) for x in v)]
    code = lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    centroids = [list(v) for _, v in sorted(kept, key=code)[:clusters]]
    for step in range(rounds + 1):
        best = [min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids)) for _, v in kept]
        for k in range(len(centroids) if step < rounds else 0):
            own = [v for (_, v), (_, n) in zip(kept, best) if n == k]
            if own:
                centroids[k] = [sum(x) // len(own) for x in zip(*own)]
    inertia = {k: sum(d for d, n in best if n == k) for k in range(len(centroids))}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, k, d, inertia[k], sum(inertia.values()), sha[k]) for (i, _), (d, k) in zip(kept, best)), key=str)


def odd_rows(n, seed, scale=1.0):
    rng = random.Random(seed)
    centers = [[rng.gauss(0, scale) for _ in range(64)] for _ in range(5)]
    rows = [(k, [float(np.float32(x + rng.gauss(0, scale / 4))) for x in rng.choice(centers)]) for k in range(n)]
    rows += [(n + k, rows[k][1]) for k in range(10)]  # copies: ties between centroids
    rows += [(3, rows[4][1]), (3, rows[3][1]), (None, rows[5][1]), (n + 20, None), (n + 21, [1.0] * 63), (n + 22, []),
             (n + 23, [float("nan")] + [0.0] * 63), (n + 24, [float("inf")] + [0.0] * 63), (n + 25, [None] + [0.0] * 63),
             (n + 26, [0.0] * 64), (n + 27, [-0.0] * 64)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("n,scale,kind", [(150, 1.0, "float"), (12, 0.01, "double"), (60, 2.0e5, "double")])
def test_equal_to_brute_force(spark, n, scale, kind):
    rows = odd_rows(n, 5, scale)
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], f"vec_id long, embedding array<{kind}>, q int, cluster string")
    got = cc.cluster_vectors(df.repartition(4), clusters=9, rounds=3).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 9, 3)


def test_sql_agrees(spark):
    rows = odd_rows(70, 8)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    con = duckdb.connect()
    con.register("embeddings", df.toArrow())
    got = cc.cluster_vectors(df)
    want = con.sql(cc.SQL)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want.select(", ".join(got.columns)).fetchall(), key=str)


def test_transform_keeps_distances_and_search_drops_only_worse():
    rng = np.random.default_rng(3)
    x, c = rng.integers(-500, 500, (300, 64)), rng.integers(-500, 500, (17, 64))
    c[5] = c[11]
    x[:20] = c[rng.integers(0, 17, 20)]
    plain = ((x[:, None] - c[None]) ** 2).sum(axis=2)
    number, distance = cc.nearest(cc.transform(x), cc.transform(c))
    assert (number == plain.argmin(axis=1)).all() and (distance == plain.min(axis=1)).all()
    assert (cc.transform(x)[:, 0] == x.sum(axis=1)).all()


def test_empty_and_too_large(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    out = cc.cluster_vectors(empty)
    assert out.collect() == []
    assert dict(out.dtypes) == {"vec_id": "bigint", "cluster": "int", "distance": "bigint", "cluster_inertia": "bigint",
                                "inertia": "bigint", "centroid_sha256": "string"}
    with pytest.raises(Exception, match="don't fit a long"):
        cc.cluster_vectors(spark.createDataFrame([(1, [1e300] * 64)], "vec_id long, embedding array<double>"))

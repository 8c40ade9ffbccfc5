"""Centroid clustering with a progressive search in the Walsh-Hadamard domain.

Vectors are turned into integers (floor(``SCALE`` * x)) and written once. Integer vectors and
centroids go through the Walsh-Hadamard transform, exactly; of the transform's coefficients,
taken from few sign changes to many, the squared differences add up to 64 times the squared
distance. A vector's partial sum to a centroid only grows with each step of the search (1, 2, 4,
8, 16, 32, 64 coefficients), so a centroid whose partial sum passes the whole sum of the best one so
far is strictly worse and leaves; those that stay are finished to all 64. Ties stay to the end and go
to the smaller number.

A round is one pass over the integers: every task adds up its vectors per centroid (at most
``clusters`` rows of 64 sums), the sums of all tasks are added by Spark and the new centroids, some
40 x 64 integers whatever the table's size, are computed on the driver.

Defined results: vectors that are null, have another number of components than 64, or a null or
non-finite one, have no row; repeated ids and vectors are rows of their own; a null id is
clustered but never a first centroid unless ids run out; of rows that share an id, the one with the
least components comes first as a first centroid; with fewer vectors than clusters there
are as many clusters as vectors; an empty table gives an empty result; other columns aren't
read. Components that don't fit 31 bits after scaling stop the job, since their distances don't fit
a long; so do sums of distances that don't.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, table, written

DIM = 64
SCALE = 256
CLUSTERS = 40
ROUNDS = 5
SEED = 2
#: Vectors searched at once.
CHUNK = 2048
#: Integers up to this size give sums of 64 bits at every step; larger ones are Python integers.
SMALL = 1 << 22
LARGEST = 1 << 31


def transform(x):
    """Walsh-Hadamard transform of each row of integers, coefficients by sign changes."""
    import numpy as np
    x, width = x.copy(), 1
    while width < DIM:
        x = x.reshape(-1, DIM // (2 * width), 2, width)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2)
        x, width = x.reshape(-1, DIM), 2 * width
    return x[:, by_sign_changes()]


def by_sign_changes() -> list[int]:
    """The transform's rows in the order of their sign changes."""
    def changes(row):
        signs = [(row & k).bit_count() & 1 for k in range(DIM)]
        return sum(a != b for a, b in zip(signs, signs[1:]))
    return sorted(range(DIM), key=changes)


def nearest(vectors, centroids):
    """(number of the nearest centroid, squared distance) of each row, both transformed."""
    import numpy as np
    n, k = len(vectors), len(centroids)
    row, col = np.repeat(np.arange(n), k), np.tile(np.arange(k), n)
    partial = np.zeros(n * k, vectors.dtype)
    bound = None
    done = 0
    while done < DIM:
        end = max(1, 2 * done)
        difference = vectors[row, done:end] - centroids[col, done:end]
        partial = partial + (difference * difference).sum(axis=1)
        done = end
        starts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        least = np.minimum.reduceat(partial, starts)
        if done < DIM:  # the whole sum of the centroid that leads bounds the best
            leads = np.flatnonzero(partial == np.repeat(least, np.diff(np.append(starts, len(row)))))
            leads = leads[np.concatenate([[True], row[leads][1:] != row[leads][:-1]])]
            whole = vectors - centroids[col[leads]]
            whole = (whole * whole).sum(axis=1)
            bound = whole if bound is None else np.minimum(bound, whole)
            stay = partial <= bound[row]
            row, col, partial = row[stay], col[stay], partial[stay]
    best = np.flatnonzero(partial == np.repeat(least, np.diff(np.append(starts, len(row)))))
    best = best[np.concatenate([[True], row[best][1:] != row[best][:-1]])]
    return col[best], partial[best] // DIM


def _quantize(batches):
    """(vec_id, vector of finite doubles) -> (vec_id, integers)."""
    import numpy as np
    import pyarrow as pa
    for batch in batches:
        values = batch.column(1).flatten().to_numpy(zero_copy_only=False)
        with np.errstate(over="ignore"):
            q = np.floor(SCALE * values)
        if len(q) and not np.abs(q).max() < LARGEST:
            raise ValueError(f"components beyond {LARGEST // SCALE}: their distances don't fit a long")
        ints = pa.ListArray.from_arrays(np.arange(0, len(q) + 1, DIM, dtype=np.int32), pa.array(q.astype(np.int64)))
        yield pa.RecordBatch.from_arrays([batch.column(0), ints], ["vec_id", "q"])


def _chunks(batch, centroids):
    """(rows, integers, number, distance) of pieces of a batch."""
    import numpy as np
    for start in range(0, batch.num_rows, CHUNK):
        piece = batch.slice(start, CHUNK)
        q = piece.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, DIM)
        c = np.array(centroids, object)
        small = max(int(np.abs(q).max()), int(max(map(abs, c.ravel())))) <= SMALL
        kind = np.int64 if small else object
        number, distance = nearest(transform(q.astype(kind)), transform(c.astype(kind)))
        yield piece, q, number, distance


def _sums(centroids):
    """A task's vectors -> (cluster, n, sums) of each cluster it meets."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        k = len(centroids)
        n, sums = np.zeros(k, np.int64), np.zeros((k, DIM), np.int64)
        for batch in batches:
            for _, q, number, _ in _chunks(batch, centroids):
                n += np.bincount(number, minlength=k)
                order = np.argsort(number, kind="stable")
                met, starts = np.unique(number[order], return_index=True)
                sums[met] += np.add.reduceat(q[order], starts, axis=0)
        met = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(met.astype(np.int32)), pa.array(n[met]), pa.array(sums[met].tolist(), pa.list_(pa.int64()))],
            ["cluster", "n", "sums"])
    return run


def _assign(centroids):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            for piece, _, number, distance in _chunks(batch, centroids):
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array(number.astype(np.int32)), pa.array(distance.tolist(), pa.int64())],
                    ["vec_id", "cluster", "distance"])
    return run


def integers(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, q) of the vectors that have 64 finite components."""
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.where(F.coalesce((F.size(v) == DIM) & finite, F.lit(False)))
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), v.cast("array<double>").alias("v"))
    return rows.mapInArrow(_quantize, "vec_id long, q array<long>")


def first_centroids(rows: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> list[list[int]]:
    """The vectors whose seeded id hashes are the smallest: a top-k of stated size."""
    code = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    return [r["q"] for r in rows.orderBy(code.asc_nulls_last(), "q").limit(clusters).select("q").collect()]


def next_centroids(rows: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The mean, rounded down, of the vectors nearest to each centroid; one without vectors stays."""
    parts = rows.mapInArrow(_sums(centroids), "cluster int, n long, sums array<long>")
    cells = parts.select("cluster", "n", F.posexplode("sums").alias("place", "x"))
    wide = "decimal(38,0)"
    out = [list(c) for c in centroids]
    for r in (cells.groupBy("cluster", "place").agg(F.sum(F.col("n").cast(wide)).alias("n"), F.sum(F.col("x").cast(wide)).alias("x"))
              .collect()):  # clusters x 64 rows
        out[r["cluster"]][r["place"]] = int(r["x"]) // int(r["n"])
    return out


def cluster_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept vector."""
    spark, paths = vectors.sparkSession, []
    rows = written(integers(vectors, id_col, vector_col), "op13-integers", paths)
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    centroids = first_centroids(rows, clusters, seed)
    if not centroids:
        return rows.selectExpr("vec_id", "0 AS cluster", "0L AS distance", "0L AS cluster_inertia", "0L AS inertia",
                               "'' AS centroid_sha256")  # no rows
    for _ in range(rounds):
        centroids = next_centroids(rows, centroids)
    assigned = written(rows.mapInArrow(_assign(centroids), "vec_id long, cluster int, distance long"), "op13-assigned")
    discard(spark, paths)
    inertia = {r["cluster"]: int(r["x"]) for r in assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("x")).collect()}  # one row a cluster
    total = sum(inertia.values())
    facts = [(k, x, total, hashlib.sha256(",".join(map(str, centroids[k])).encode()).hexdigest())
             for k, x in inertia.items()]
    return (assigned.join(F.broadcast(spark.createDataFrame(facts, schema)), "cluster")  # ``clusters`` rows at most
            .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings"))


def oracle(clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> str:
    """DuckDB SQL of the same clustering by plain distances."""
    out = [f"""WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings WHERE len(embedding) = {DIM} AND len(list_filter(embedding, lambda x: isfinite(x))) = {DIM}
), c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY h NULLS LAST, q) - 1 AS INTEGER) AS k, q AS c FROM (
    SELECT sha256('{seed}:' || CAST(vec_id AS VARCHAR)) AS h, q FROM v ORDER BY h NULLS LAST, q LIMIT {clusters})
)"""]
    for r in range(rounds + 1):
        out.append(f"""d{r} AS MATERIALIZED (
  SELECT rid, k, list_sum(list_transform(range(1, {DIM + 1}), lambda i: (q[i] - c[i]) * (q[i] - c[i]))) AS d FROM v, c{r}
), a{r} AS MATERIALIZED (
  SELECT rid, k, d FROM (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY d, k) AS best FROM d{r}) WHERE best = 1
)""")
        if r < rounds:
            out.append(f"""m{r} AS MATERIALIZED (
  SELECT k, list(x ORDER BY i) AS c FROM (
    SELECT k, i, CAST(s // n - CASE WHEN s % n < 0 THEN 1 ELSE 0 END AS BIGINT) AS x FROM (
      SELECT k, i, sum(q[i]) AS s, CAST(count(*) AS HUGEINT) AS n
      FROM a{r} JOIN v USING (rid), (SELECT unnest(range(1, {DIM + 1})) AS i) GROUP BY k, i))
  GROUP BY k
), c{r + 1} AS MATERIALIZED (
  SELECT k, coalesce(m{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN m{r} USING (k)
)""")
    return ",\n".join(out) + f"""
SELECT vec_id, k AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN v USING (rid) JOIN c{rounds} USING (k)"""


SQL = oracle()

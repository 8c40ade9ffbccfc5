"""Near-duplicate vectors: random-hyperplane hashing, exact cosines, components.

Identical vectors are collapsed first (a group of copies is one vector with a weight).
Each distinct vector gets, in each of several tables, a signature of sign bits of its
projections on seeded random directions. Vectors of one table and signature are compared
exactly, in double precision, as a matrix product. Bits grow with the logarithm of the
number of vectors (about 16 per bucket if directions are even) and tables follow from the
chance to miss a pair that lies exactly on the threshold: with p = 1 - acos(t) / pi per bit,
``MISS`` >= (1 - p^bits)^tables. Pairs above the threshold are missed less often.

A pair met in several tables counts in the first only. A bucket of more than ``BLOCK``
vectors is cut into blocks and every pair of blocks is a unit of work of its own, so no
task holds more than two blocks. A unit returns sums and one edge per vector, never pairs.

Defined results: vectors that are null, empty, all zero or hold a null or non-finite
component link with nothing (their component is their own id); vectors of different
length never link; repeated ids are rows of their own that share an id; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import runs, table, written
from .components import connected_components

THRESHOLD = 0.95
MISS = 0.0005
PER_BUCKET = 16
BLOCK = 2048
SEED = 7


def plan_tables(n: int, threshold: float = THRESHOLD, miss: float = MISS) -> tuple[int, int]:
    """(bits, tables) for ``n`` vectors."""
    bits = min(40, max(6, math.ceil(math.log2(max(n, 1) / PER_BUCKET + 1))))
    hit = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(2, math.ceil(math.log(miss) / math.log(1 - hit)))


def usable(vector: Column) -> Column:
    """True for vectors that have a direction."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _unit(column):
    """Rows of a list column of equal lengths as unit vectors in double precision."""
    import numpy as np
    x = np.asarray(column.values.slice(column.offsets[0].as_py(), column.offsets[-1].as_py() - column.offsets[0].as_py()),
                   dtype=np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _sign(bits: int, tables: int, seed: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        planes: dict = {}
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                dims = np.array(batch.column(0).to_pylist())
                for dim in sorted(set(dims.tolist())):
                    part = batch.filter(pa.array(dims == dim))
                    if dim not in planes:
                        rng = np.random.default_rng([seed, dim])
                        planes[dim] = rng.standard_normal((dim, bits * tables))
                    signs = (_unit(part.column(3)) @ planes[dim] >= 0).reshape(-1, tables, bits)
                    sig = (signs * (1 << np.arange(bits, dtype=np.int64))).sum(axis=2)
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns, pa.array(sig.tolist(), pa.list_(pa.int64()))],
                        [*part.schema.names, "sigs"])
    return run


def _compare(threshold: float):
    """Units (dim, t, sig, i, j) with rows (.., side, rep, weight, vec, sigs) -> (rep, links, root)."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        for unit in runs(batches, 5):
            unit = unit.combine_chunks()
            if unit.num_rows < 2:
                continue
            t, cross = unit.column(1)[0].as_py(), unit.column(3)[0].as_py() != unit.column(4)[0].as_py()
            side, rep, weight = (unit.column(k).to_numpy() for k in (5, 6, 7))
            x = _unit(unit.column(8).chunk(0))
            sigs = np.array(unit.column(9).to_pylist(), np.int64)
            linked = np.zeros((len(rep), len(rep)), bool)
            for a in range(0, len(rep), 512):
                linked[a:a + 512] = x[a:a + 512] @ x.T >= threshold
            np.fill_diagonal(linked, False)
            linked |= linked.T  # the product needn't be symmetrical in its last bit
            if cross:
                linked &= side[:, None] != side[None, :]
            # A pair that agrees in an earlier table was counted there.
            a, b = np.nonzero(np.triu(linked))
            fresh = linked
            if t and len(a):
                fresh = np.zeros_like(linked)
                for k in range(0, len(a), 100_000):
                    p, q = a[k:k + 100_000], b[k:k + 100_000]
                    new = ~(sigs[p, :t] == sigs[q, :t]).any(axis=1)
                    fresh[p[new], q[new]] = fresh[q[new], p[new]] = True
            links = fresh.astype(np.float64) @ weight.astype(np.float64)
            # A spanning forest: every row learns the smallest id it reaches inside of the unit.
            root = rep.copy()
            while True:
                near = np.where(linked, root[None, :], np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max)
                new = np.minimum(root, near)
                if (new == root).all():
                    break
                root = new
            out = np.flatnonzero((links > 0) | (root != rep))
            if len(out):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rep[out]), pa.array(links[out].astype(np.int64)), pa.array(root[out])],
                    ["rep", "links", "root"])
    return run


def link_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                 threshold: float = THRESHOLD, miss: float = MISS, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row."""
    # Floats travel as they are (half the bytes) and are widened where they are compared.
    kind = vectors.schema[vector_col].dataType.simpleString()
    kind = kind if kind == "array<float>" else "array<double>"
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast(kind).alias("vec"))
    rows = rows.withColumn("ok", usable(F.col("vec")) & F.col("vec_id").isNotNull())
    keyed = written(rows.select("vec_id", "ok", F.when(F.col("ok"), F.xxhash64("vec")).alias("k1"),
                                F.when(F.col("ok"), F.xxhash64(F.lit(seed), "vec")).alias("k2")), "op3-keys")
    distinct = written(
        rows.where("ok").groupBy(F.xxhash64("vec").alias("k1"), F.xxhash64(F.lit(seed), "vec").alias("k2"), "vec")
        .agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("weight"))
        .select(F.size("vec").alias("dim"), "rep", "weight", "vec", "k1", "k2"), "op3-distinct")
    bits, tables = plan_tables(distinct.count(), threshold, miss)
    signed = written(distinct.select("dim", "rep", "weight", "vec").mapInArrow(
        _sign(bits, tables, seed), f"dim int, rep long, weight long, vec {kind}, sigs array<long>"), "op3-signed")
    posts = signed.select("dim", F.posexplode("sigs").alias("t", "sig"), "rep", "weight", "vec", "sigs")
    # Buckets of two or more; counts are pre-aggregated, so a hot bucket is one small row per task.
    sizes = written(signed.select("dim", F.posexplode("sigs").alias("t", "sig")).groupBy("dim", "t", "sig")
                    .agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                    .select("dim", "t", "sig", F.ceil(F.col("n") / block).cast("int").alias("blocks")), "op3-buckets")
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    units = (posts.join(sizes, ["dim", "t", "sig"]).withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("dim", "t", "sig", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                     F.col("own").alias("side"), "rep", "weight", "vec", "sigs"))
    order = ["dim", "t", "sig", "i", "j"]
    found = written(units.repartition(*order).sortWithinPartitions(*order).mapInArrow(
        _compare(threshold), "rep long, links long, root long"), "op3-links")
    roots = connected_components(found.where("rep != root"), "rep", "root")
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    reps = written(distinct.select("k1", "k2", "rep", "weight").join(counts, "rep", "left")
                   .join(roots, F.col("rep") == F.col("node"), "left")
                   .select("k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                           F.coalesce("component", "rep").alias("component_id")), "op3-reps")
    out = keyed.join(reps, ["k1", "k2"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def query(spark, sf_dir: str) -> DataFrame:
    return link_vectors(table(spark, sf_dir, "embeddings"))

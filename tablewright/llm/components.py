"""Connected components of a graph of any size, as joins and aggregations.

Large-star and small-star steps in turn (Kiveris et al., "Connected Components in
MapReduce and Beyond", 2014): every step keeps the components and moves edges towards the
smallest node, until all nodes hang on it directly. Each step is written to the shared
folder; nothing but a row count and a checksum reaches the driver. Node minima are written
before they are joined, so that the planner knows their size and can split a hot node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, written


def _pairs(df: DataFrame, a, b) -> DataFrame:
    return df.select(a.alias("u"), b.alias("v"))


def _large_star(edges: DataFrame, paths: list[str]) -> DataFrame:
    u, v = F.col("u"), F.col("v")
    both = edges.unionByName(_pairs(edges, v, u))
    low = written(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("low")), "components-low", paths)
    out = both.where(v > u).join(low, "u").select(v.alias("u"), F.col("low").alias("v"))
    return written(out.distinct(), "components-large", paths)


def _small_star(edges: DataFrame, paths: list[str]) -> DataFrame:
    """``edges`` has u > v in every row."""
    low = written(edges.groupBy("u").agg(F.min("v").alias("low")), "components-low", paths)
    moved = edges.join(low, "u").where("v != low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return written(moved.unionByName(_pairs(low, F.col("u"), F.col("low"))).distinct(), "components-small", paths)


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", paths: list[str] | None = None) -> DataFrame:
    """(node, component) of every node that has an edge to another and isn't its component's
    smallest; component is the smallest node that can be reached. Repeated edges, loops and
    either direction are allowed; edges with a null end are no edges. ``paths`` learns where the
    result is written."""
    x, y = F.col(a).cast("long"), F.col(b).cast("long")
    current: list[str] = []
    edges = written(edges.where(x != y).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct(),
                    "components-edges", current)
    before = _state(edges)
    while before[0]:
        old, new = current, []
        edges = _small_star(_large_star(edges, old), new)
        now = _state(edges)
        current = [new.pop()]  # the last table is the step's result
        discard(edges.sparkSession, old + new)
        if now == before:
            break
        before = now
    if paths is not None:
        paths += current
    return _pairs(edges, F.col("u"), F.col("v")).toDF("node", "component")

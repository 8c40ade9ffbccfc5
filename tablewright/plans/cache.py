"""Reuse of derived tables across reports (the reference's SELECT INTO / temp table).

A derived table that many reports read is built once per session and input.
Two ways, chosen by the session setting ``tablewright.materialize``; unset, a
``local`` master takes ``cache`` and any cluster ``table``:

* ``cache``: persisted MEMORY_AND_DISK; partitions that do not fit
  spill to local disk, partitions lost with an executor are recomputed from
  lineage, and the key layout of the table (e.g. hash-partitioned by
  OrderID) is kept for later joins.
* ``table``: written as an external parquet table under the cluster's shared
  folder (``spark.checkpoint.dir``), bucketed by its join key where one is
  given, and read back. This cuts the lineage, survives lost executors
  without recomputation, keeps co-located joins shuffle-free, and is the form
  for tables far larger than the cluster's memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from ..session import delete_path, release_scratch, session_id, shared_dir

MODE_CONF = "tablewright.materialize"

_TABLES: dict[tuple, DataFrame] = {}
_STORED: dict[tuple, tuple[str, str]] = {}  # (table, folder) of what is written


def mode_of(spark: SparkSession) -> str:
    """The session's setting; unset, what survives lost executors wherever there are any."""
    return spark.conf.get(MODE_CONF, None) or default_mode(spark.conf.get("spark.master", ""))


def default_mode(master: str) -> str:
    return "cache" if master == "local" or master.startswith("local[") else "table"


def cached(spark: SparkSession, key: tuple, build: Callable[[], DataFrame],
           bucket_by: list[str] | None = None) -> DataFrame:
    """The derived table ``build()`` for ``key``, built once per session.

    ``bucket_by``: in ``table`` mode the table is bucketed by
    these columns into ``spark.sql.shuffle.partitions`` buckets, so joins of
    two such tables on that key read matching buckets without a shuffle. (In
    ``cache`` mode the caller's hash partitioning is kept by the cache.)
    """
    mode = mode_of(spark)
    full = (session_id(spark), mode) + tuple(key) + fingerprint(spark, key)
    df = _TABLES.get(full)
    if df is not None and df.sparkSession is spark:
        return df
    if mode == "table":
        digest = hashlib.sha1(repr(full).encode()).hexdigest()[:16]
        name = f"{key[0]}_{digest}"
        path = f"{shared_dir(spark)}/tables/{name}"
        writer = build().write.mode("overwrite").format("parquet").option("path", path)
        if bucket_by:
            buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
            # No sortBy: no reader relies on it, and the write's sort is by the bucket's number alone.
            writer = writer.bucketBy(buckets, *bucket_by)
        writer.saveAsTable(name)
        _STORED[full] = (name, path)
        df = spark.table(name)
    else:
        df = build().persist(StorageLevel.MEMORY_AND_DISK)
    _TABLES[full] = df
    return df


def release(spark: SparkSession | None = None) -> None:
    """Forget every table this module holds for the session: unpersist what is cached, drop what
    is written, files included. With a session, also delete what its queries wrote in the shared folder."""
    for full in list(_TABLES):
        if spark is None or full[0] == session_id(spark):
            df = _TABLES.pop(full)
            if df.is_cached:
                df.unpersist()
            stored = _STORED.pop(full, None)
            if stored is not None:
                drop_if_exists(df.sparkSession, *stored)
    if spark is not None:
        release_scratch(spark)


def drop_if_exists(spark: SparkSession, name: str, path: str | None = None) -> None:
    """DROP TABLE / VIEW IF EXISTS: the temp view or table of this name, and its files."""
    if not spark.catalog.dropTempView(name):
        spark.sql(f"DROP TABLE IF EXISTS `{name}`")
    if path is not None:
        delete_path(spark, path)


def fingerprint(spark: SparkSession, key: tuple) -> tuple:
    """Names, lengths and times of the files under every folder that ``key`` names: changed
    input makes a new table instead of an old answer."""
    found = []
    for part in key:
        if not (isinstance(part, str) and "/" in part):
            continue
        root = spark._jvm.org.apache.hadoop.fs.Path(part)
        fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if fs.exists(root):
            found += sorted((s.getPath().getName(), s.getLen(), s.getModificationTime())
                            for s in fs.listStatus(root))
    return tuple(found)

"""Spark session and shared-folder helpers.

All jobs run on whatever session the caller hands in. ``get_session`` is only
for tests, the bench and local runs: it pins the settings the results depend
on (UTC, ANSI) and turns the web UI off.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager
from urllib.parse import urlparse

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "tablewright") -> SparkSession:
    """Local session with the settings our results depend on."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g"))
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    # No checkpoint folder here: a configured one is kept, and ``shared_dir`` makes a
    # local one for a local session that has none.
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None for a Spark Connect session."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions have no SparkContext
        return None


def session_id(spark: SparkSession) -> str:
    sc = _context(spark)
    if sc is not None:
        return sc.applicationId
    return spark.conf.get("spark.app.id", None) or str(id(spark))


_LOCAL_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    A session on a ``local`` master that has none (tests, notebooks) gets a temporary one;
    on any other master a local folder would lose what executors write, so that raises.
    """
    path = spark.conf.get(CHECKPOINT_CONF, None)
    sc = _context(spark)
    if not path and sc is not None:
        path = sc.getCheckpointDir()
    if not path:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        sid = session_id(spark)
        if sid not in _LOCAL_DIRS:
            _LOCAL_DIRS[sid] = tempfile.mkdtemp(prefix="tablewright-ckpt-")
        path = _LOCAL_DIRS[sid]
        if sc is not None:
            sc.setCheckpointDir(path)
    elif sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path.rstrip("/")


_SCRATCH: dict[str, list[str]] = {}


def lasting_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder that no release deletes: for files that are handed to
    the executors."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared folder for one job's output, until its release."""
    path = lasting_path(spark, name)
    _SCRATCH.setdefault(session_id(spark), []).append(path)
    return path


def release_scratch(spark: SparkSession, keep: int = 0) -> None:
    """Delete every folder that ``scratch_path`` gave the session, but for the first ``keep``.

    Files handed to the executors by ``addFile`` stay: one that starts later, in place of a lost one,
    fetches them all."""
    paths = _SCRATCH.get(session_id(spark), [])
    handed = [urlparse(f).path for f in spark.sparkContext.listFiles]
    for path in paths[keep:]:
        if urlparse(path).path not in handed:
            delete_path(spark, path)
            paths.remove(path)  # a folder that can't be deleted stays listed


@contextmanager
def scratch(spark: SparkSession):
    """What queries write inside of this block is deleted at its end: use their results in it.

    with scratch(spark):
        query(spark, folder).write.parquet(...)
    """
    keep = len(_SCRATCH.get(session_id(spark), []))
    try:
        yield
    finally:
        release_scratch(spark, keep)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder or file through Spark's file systems (any URI); no error if absent."""
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def move(spark: SparkSession, source: str, target: str) -> bool:
    """Move a folder inside of one file system; False if there is none."""
    fs, old = _file_system(spark, source)
    if not fs.exists(old):
        return False
    new = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(new.getParent())
    return fs.rename(old, new)


def set_file_times(spark: SparkSession, folder: str, millis: int) -> None:
    """Give every file of a folder one modification time (a file stream reads the oldest first)."""
    fs, target = _file_system(spark, folder)
    for status in fs.listStatus(target):
        fs.setTimes(status.getPath(), millis, -1)


def empty_files(spark: SparkSession, path: str) -> list[str]:
    """Files without a byte among those that a reader of ``path`` (a file, folder or pattern) would take."""
    fs, target = _file_system(spark, path)
    found = []
    for status in fs.globStatus(target) or []:
        for file in fs.listStatus(status.getPath()) if status.isDirectory() else [status]:
            if file.isFile() and file.getLen() == 0 and file.getPath().getName()[0] not in "._":
                found.append(file.getPath().toString())
    return found


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """One file of bounded size, through Spark's file systems (any URI)."""
    fs, target = _file_system(spark, path)
    out = fs.create(target, True)
    try:
        out.write(data)
    finally:
        out.close()

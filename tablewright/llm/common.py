"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

#: Words between ASCII white space (space, \t \n \v \f \r), as a regular expression and,
#: for bytes, what ``bytes.split()`` cuts at.
WORD = r"[^\x20\x09-\x0D]+"

#: Documents that a worker takes out of an Arrow batch at once. The batch itself is bounded by Spark
#: (``spark.sql.execution.arrow.maxRecordsPerBatch`` and ``maxBytesPerBatch``, 64 MB by default).
BATCH_ROWS = 256

#: Bytes of an Arrow batch of texts: the JVM and a worker each hold one a task, beside copies while it grows.
BATCH_BYTES = 4 << 20

#: The longest word that a worker remembers.
MEMO_LENGTH = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, paths: list[str] | None = None) -> DataFrame:
    """``df`` written as Parquet into the shared folder and read back: cuts the lineage, and
    a lost executor costs no recomputation of what lies before. ``paths`` learns where."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    if paths is not None:
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables that ``written`` made, once all that was derived from them is written itself."""
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    paths.clear()


def bounded_batches(spark: SparkSession) -> None:
    """Lower the session's limit on the bytes of an Arrow batch to ``BATCH_BYTES``, if it is higher."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    parse = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    held = parse(spark.conf.get(name, "64m"))
    if held <= 0 or held > BATCH_BYTES:
        spark.conf.set(name, f"{BATCH_BYTES}b")


def ascii_lower(col: Column) -> Column:
    """A-Z lower-cased, everything else as it is."""
    return F.translate(col, UPPER, LOWER)


def text_bytes(col: str = "text") -> Column:
    """The text as UTF-8 bytes; null becomes empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")


def texts_of(piece) -> list[bytes]:
    """The texts of a batch: its last column, as bytes; null is empty."""
    import pyarrow as pa
    return [t or b"" for t in piece.column(piece.num_columns - 1).cast(pa.binary()).to_pylist()]


def without_text(docs: DataFrame, text_col: str = "text") -> Column:
    """All columns of ``docs`` but the text, as one: the text travels once, beside them."""
    return F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in docs.columns if c != text_col])


def rejoined(docs: DataFrame, rows: DataFrame, text_col: str = "text") -> DataFrame:
    """The columns of ``docs`` from rows (carried, text as bytes, ..) that ``without_text`` made."""
    kind = docs.schema[text_col].dataType
    text = F.col("text") if kind.simpleString() == "binary" else F.col("text").cast("string").cast(kind)
    return rows.select(*[text.alias(c) if c == text_col else F.col("carried")[c].alias(c) for c in docs.columns])


def freed(run):
    """``run`` for ``mapInArrow``, which at its end returns the memory it took to the system: workers
    are used again, and what one operator leaves behind would add to the next one's."""
    def tidy(batches):
        yield from run(batches)
        import ctypes
        import gc

        import pyarrow as pa
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)
    return tidy


def slices(batch, rows: int = BATCH_ROWS):
    """An Arrow batch in pieces of at most ``rows`` rows (no copy)."""
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def runs(batches, keys: int):
    """Arrow tables of consecutive rows with equal values in the first ``keys`` columns (integers
    without nulls), from batches sorted by them. One run is held at a time."""
    import numpy as np
    import pyarrow as pa
    held, current = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        change = np.zeros(batch.num_rows - 1, bool)
        for c in columns:
            change |= c[1:] != c[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            key = tuple(c[a] for c in columns)
            if key != current and held:
                yield pa.Table.from_batches(held)
                held = []
            current = key
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)

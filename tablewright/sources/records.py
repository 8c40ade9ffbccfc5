"""Delimited records whose quoted cells hold newlines, cut out of split files in parallel.

A split of such a file may begin inside a quoted cell. In RFC 4180 every quote opens or closes a cell
(a doubled one does both), so the parity of all quotes before a split tells which:

1. quotes are counted per split (an aggregate of the lines), and a running sum over the splits of a
   file, one row each, gives the splits that begin inside a cell;
2. each task cuts its splits into records in one streaming pass. What a border cuts through is handed
   on as a piece, at most two a split;
3. the pieces of a record are put together in file order, and all records are parsed by Spark's CSV
   functions.

The splits that begin inside a cell are broadcast: at most one row of a path and an offset for
``spark.sql.files.maxPartitionBytes`` of input. Lines are read three times (quotes, pieces, records).
A record must fit in a row; everything else is bounded by an Arrow batch. Records end at a newline or
at a carriage return and a newline; a quote inside an unquoted cell isn't RFC 4180 and shifts cells.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHOLE, TAIL, MIDDLE, HEAD = 0, 1, 2, 3
CUT = "file string, start bigint, kind int, first boolean, record string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.option("lineSep", "\n").text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value"))


def _begin_inside(lines: DataFrame) -> DataFrame:
    """(file, start) of the splits that begin inside a quoted cell."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return (lines.groupBy("file", "start").agg(F.sum(quotes).alias("quotes"))
            .withColumn("before", F.sum("quotes").over(earlier))
            .where("before % 2 = 1").select("file", "start", F.lit(True).alias("inside")))


def _cut(batches):
    """Records and pieces of records of lines (file, start, value, inside) in file order."""
    import pyarrow as pa
    split, buffer, inside, began, first = None, [], False, True, False
    schema = pa.schema([("file", pa.string()), ("start", pa.int64()), ("kind", pa.int32()),
                        ("first", pa.bool_()), ("record", pa.string())])

    def taken(kind):
        nonlocal buffer, first
        row = (*split, kind, first, "\n".join(buffer))
        buffer, first = [], False
        return row

    def batch(rows):
        columns = zip(*rows) if rows else [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)

    for lines in batches:
        rows = []
        for file, start, value, starts_inside in zip(*(c.to_pylist() for c in lines.columns)):
            if (file, start) != split:
                if buffer:
                    rows.append(taken(HEAD if began else MIDDLE))
                split, inside, began, first = (file, start), bool(starts_inside), not starts_inside, start == 0
            buffer.append(value)
            if value.count('"') % 2:
                inside = not inside
            if not inside:
                rows.append(taken(WHOLE if began else TAIL))
                began = True
        yield batch(rows)
    if buffer:
        yield batch([taken(HEAD if began else MIDDLE)])


def read_records(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """One column ``record``: the text of every record of the files at ``path``, blank ones and each
    file's header left out. Files may be of any size; nothing but their splits bounds a task."""
    lines = _lines(spark, path)
    inside = F.broadcast(_begin_inside(lines))
    cut = (lines.join(inside, ["file", "start"], "left").select("file", "start", "value", "inside")
           .mapInArrow(_cut, CUT))
    # A record is named by its head: the heads of its file up to the piece.
    order = Window.partitionBy("file").orderBy("start", "kind")
    joined = (cut.where(F.col("kind") != WHOLE)
              .withColumn("number", F.sum((F.col("kind") == HEAD).cast("bigint")).over(order))
              .groupBy("file", "number")
              .agg(F.max("first").alias("first"),
                   F.sort_array(F.collect_list(F.struct("start", "kind", "record"))).alias("pieces"))
              .select("first", F.array_join(F.col("pieces.record"), "\n").alias("record")))
    records = cut.where(F.col("kind") == WHOLE).select("first", "record").unionByName(joined)
    if header:
        records = records.where(~F.col("first"))
    else:  # a byte order mark isn't part of the first cell
        records = records.withColumn("record", F.when(F.col("first"), F.regexp_replace("record", r"^\uFEFF", ""))
                                     .otherwise(F.col("record")))
    return records.select(F.regexp_replace("record", r"\r\z", "").alias("record")).where("record <> ''")


def parse_records(records: DataFrame, schema: T.StructType, options: dict[str, str]) -> DataFrame:
    """The cells of ``record`` by Spark's CSV parser; names that differ only in case stay apart."""
    places = T.StructType([T.StructField(f"c{i}", f.dataType, True) for i, f in enumerate(schema.fields)])
    cells = F.from_csv("record", places.toDDL(), {**options, "multiLine": "true"}).alias("cells")
    return records.select(cells).select("cells.*").toDF(*schema.names)

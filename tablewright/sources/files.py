"""Text file sources and sinks.

All readers take a declared schema (never inferSchema): landing tables are
all-text, typed later by the cleaning steps. Writers keep values exactly as
they are (no whitespace trimming), write no index column, and write one
file per partition, so both sides scale with the number of files. Cells are
quoted as in RFC 4180 (a quote inside a cell is doubled), as pandas reads and
writes them; a row that does not fit the schema raises.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import empty_files
from .records import parse_records, read_records

TAB = "\t"
#: No cell's text: as the NULL mark it leaves quoted empty cells alone.
NO_VALUE = "\x00"


def string_schema(columns: list[str]) -> T.StructType:
    """All-text landing schema (the HR and flat-file landing tables are VARCHAR)."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",",
                   header: bool = True, multi_line: bool = False,
                   keep_empty: bool = False) -> DataFrame:
    """pd.read_csv(path[, sep]) with a declared schema; the header line is skipped.

    ``multi_line``: cells may hold newlines; files are still split (see ``records``).
    Without it a cell with a newline raises, like any malformed row.
    An empty cell is missing, as in pandas; with ``keep_empty`` a quoted empty
    cell is the empty string.
    """
    options = {"sep": sep, "quote": '"', "escape": '"', "emptyValue": "", "mode": "FAILFAST",
               "nullValue": NO_VALUE if keep_empty else ""}
    if multi_line:
        return parse_records(read_records(spark, path, header), schema, options)
    return (spark.read.schema(schema).options(**options)
            .option("header", header).option("enforceSchema", True)
            .csv(path))


def write_delimited(df: DataFrame, path: str, sep: str = ",", header: bool = True,
                    rows_per_file: int = 0) -> None:
    """df.to_csv(path, [sep,] index=False): values written unchanged, NULL as empty.

    An empty string is written as ``""`` and so differs from NULL. In a table of one column NULL is
    ``""`` too, as pandas writes it: a blank line would be no row.
    """
    if len(df.columns) == 1:
        df = df.select(F.coalesce(F.col(f"`{df.columns[0]}`").cast("string"), F.lit("")).alias(df.columns[0]))
    (df.write.mode("overwrite")
     .option("header", header).option("sep", sep)
     .option("quote", '"').option("escape", '"')
     .option("maxRecordsPerFile", rows_per_file)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))


def read_csv(spark, path, schema, **options):
    return read_delimited(spark, path, schema, ",", **options)


def read_tsv(spark, path, schema, **options):
    return read_delimited(spark, path, schema, TAB, **options)


def write_csv(df, path, rows_per_file=0):
    write_delimited(df, path, ",", rows_per_file=rows_per_file)


def write_tsv(df, path, rows_per_file=0):
    write_delimited(df, path, TAB, rows_per_file=rows_per_file)


# ------------------------------------------------------------- keyed JSON

#: Entries of one batch.
JSON_ROWS = 1024


def _as_text(value) -> str | None:
    """An attribute as a text cell: numbers as they were written, nested values as JSON."""
    import json
    if value is None or isinstance(value, str):
        return value
    if isinstance(value, bool):
        return "true" if value else "false"
    return json.dumps(value, ensure_ascii=False)


def _entries(text: str, path: str):
    """(key, {attribute: text}) of a document ``[{key: {..}, ..}, ..]``, one entry at a time."""
    import json
    import re
    decode = json.JSONDecoder(parse_float=str, parse_int=str, parse_constant=str).raw_decode
    blank = re.compile(r"[ \t\n\r]*").match

    def fail(at):
        return ValueError(f"not a keyed JSON document: {path}, character {at}")

    def value(at, kind):
        try:
            found, end = decode(text, at)
        except json.JSONDecodeError as e:
            raise fail(e.pos) from None
        if not isinstance(found, kind):
            raise fail(at)
        return found, blank(text, end).end()

    def take(at, marks):
        if text[at:at + 1] not in marks or at >= len(text):
            raise fail(at)
        return text[at], blank(text, at + 1).end()

    def members(at, close, one):
        """Walk over comma-separated members up to ``close``."""
        if text[at:at + 1] == close:
            return blank(text, at + 1).end()
        while True:
            at = yield from one(at)
            mark, at = take(at, ("," , close))
            if mark == close:
                return at

    def entry(at):
        key, at = value(at, str)
        at = take(at, (":",))[1]
        attributes, at = value(at, dict)
        yield key, {k: _as_text(v) for k, v in attributes.items()}
        return at

    def item(at):
        return (yield from members(take(at, ("{",))[1], "}", entry))

    end = yield from members(take(blank(text, 0).end(), ("[",))[1], "]", item)
    if end < len(text):
        raise fail(end)


def _read_documents(batches):
    import pyarrow as pa
    kind = pa.map_(pa.string(), pa.string())

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.string()),
                                           pa.array([list(a.items()) for _, a in rows], kind)], ["key", "attrs"])

    for files in batches:
        for k in range(files.num_rows):
            path, rows = files.column(0)[k].as_py(), []
            for row in _entries(files.column(1)[k].as_py().decode("utf-8-sig"), path):
                rows.append(row)
                if len(rows) == JSON_ROWS:
                    yield batch(rows)
                    rows = []
            yield batch(rows)


def read_keyed_json(spark: SparkSession, path: str, key_column: str,
                    attributes: list[str] | None = None) -> DataFrame:
    """Files holding ``[{"<key>": {attribute: value, ...}, ...}]``, one document each.

    ``json.load(f)[0]`` then ``DataFrame.from_dict(orient="index")`` with the
    index as ``key_column``. Every file is one task, which holds its text and yields its entries in
    batches; rows of all objects in the list are kept, and of an attribute named twice the last. A file
    that is not such a document, an empty one or one with text after the document raises with its path
    (an empty list is one without rows). Attribute names are kept exactly, so "Rating" and
    "rating" stay two columns. Without ``attributes`` the names are found by
    a distinct over the map keys (a schema-sized result, like inference).
    """
    for empty in empty_files(spark, path):  # Spark's readers skip them
        raise ValueError(f"not a keyed JSON document: {empty} is empty")
    docs = spark.read.format("binaryFile").load(path).select("path", "content")
    items = docs.mapInArrow(_read_documents, "key string, attrs map<string, string>")
    if attributes is None:
        attributes = sorted(r[0] for r in items.select(F.explode(F.map_keys("attrs")))
                            .distinct().collect())
    return items.select(F.col("key").alias(key_column),
                        *[F.col("attrs").getItem(a).alias(a) for a in attributes])


def write_keyed_json(df: DataFrame, path: str, key_column: str,
                     rows_per_file: int = 100_000) -> None:
    """Keyed JSON documents of at most ``rows_per_file`` rows, one file each.

    Rows are numbered inside their partition (``monotonically_increasing_id``
    keeps the row position in its low bits), so a document is one slice of
    one partition and its size is bounded whatever the partitioning.
    """
    names = df.columns
    key_at = names.index(key_column)
    df = df.toDF(*[f"_c{i}" for i in range(len(names))])  # "Rating" and "rating" may both occur
    pairs = []
    for i, a in enumerate(names):
        if i != key_at:
            pairs += [F.lit(a), F.col(f"_c{i}").cast("string")]
    entry = F.to_json(F.create_map(F.col(f"_c{key_at}"), F.create_map(*pairs)))
    inner = F.regexp_replace(entry, r"^\{|\}$", "")
    row_in_part = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    doc = F.concat_ws("-", F.spark_partition_id().cast("string"),
                      F.floor(row_in_part / F.lit(rows_per_file)).cast("string"))
    (df.select(doc.alias("doc"), inner.alias("e"))
     .groupBy("doc")
     .agg(F.concat(F.lit("[{"), F.array_join(F.collect_list("e"), ","), F.lit("}]"))
          .alias("value"))
     .write.mode("overwrite").partitionBy("doc").text(path))

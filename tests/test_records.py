"""Files whose cells hold newlines are read by several tasks, whatever the borders cut through."""

import csv
import os
import random
import tempfile

import pytest

from pyspark.sql import functions as F

from tablewright.sources import files, records


def _write(rows, header=("a", "B", "b"), end="\n", sep=","):
    folder = tempfile.mkdtemp(prefix="tablewright-test-")
    with open(os.path.join(folder, "x.csv"), "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f, delimiter=sep, lineterminator=end)
        out.writerows(([header] if header else []) + rows)
    return folder


@pytest.fixture
def small_splits(spark):
    saved = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for k in saved:
        spark.conf.set(k, "97")
    yield
    for k, v in saved.items():
        spark.conf.set(k, v)


def _rows(seed, n=120):
    rng = random.Random(seed)
    parts = ["x", "é", '"', "\n", "\n\n", ",", "\r\n", " ", "日本", "long " * 60 + "\n", "", "\t"]
    return [[f"r{i}"] + ["".join(rng.choice(parts) for _ in range(rng.randrange(6))) for _ in range(2)] for i in range(n)]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("sep", [",", "\t"])
def test_records_over_split_borders(spark, small_splits, end, sep):
    rows = _rows(end + sep)
    for header in (("a", "B", "b"), ("head\nline " * 40, "B", "b"), None):
        folder = _write(rows, header, end, sep)
        schema = files.string_schema(["a", "B", "b"])
        got = files.read_delimited(spark, folder, schema, sep, header=header is not None, multi_line=True, keep_empty=True)
        assert got.columns == ["a", "B", "b"]
        found = sorted([c or "" for c in r] for r in got.collect())
        assert found == sorted(rows)


def test_one_file_is_read_by_several_tasks(spark, small_splits):
    folder = _write(_rows(5))
    tasks = records._lines(spark, folder).select(F.spark_partition_id().alias("t"), "start").distinct().collect()
    assert len({r["t"] for r in tasks}) > 10
    inside = records._begin_inside(records._lines(spark, folder)).count()
    assert 0 < inside < len(tasks)


def test_round_trip_with_missing_and_malformed_rows(spark, small_splits):
    df = spark.createDataFrame([(None, None), ("a\nb", None), (None, 'q"\n\n"'), ("", "z")] * 9, "a string, b string")
    folder = os.path.join(tempfile.mkdtemp(prefix="tablewright-test-"), "t")
    files.write_csv(df.coalesce(1), folder)
    got = files.read_csv(spark, folder, df.schema, multi_line=True, keep_empty=True)
    assert sorted(got.collect(), key=repr) == sorted(df.collect(), key=repr)
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_csv(spark, _write([["1", "2", "3"], ["4\n5", "6"]]), files.string_schema(["a", "B", "b"]), multi_line=True).collect()

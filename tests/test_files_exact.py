"""CSV / TSV cells as pandas reads and writes them; malformed input raises; temp tables are released."""

import pandas as pd
import pytest

from tablewright.operators import relational as R
from tablewright.plans import cache
from tablewright.sources import files

CELLS = ['x "y", z', "line one\nline two", "plain", "", " padded ", "tab\there", '"', "semi;colon", "é\n\"q\"\n"]


@pytest.mark.parametrize("write,read,sep", [(files.write_csv, files.read_csv, ","), (files.write_tsv, files.read_tsv, "\t")])
def test_cells_survive_both_ways(spark, tmp_path, write, read, sep):
    rows = [(i, c) for i, c in enumerate(CELLS)] + [(99, None)]
    df = spark.createDataFrame(rows, "k int, a string")
    ours = str(tmp_path / "ours")
    write(df.coalesce(1), ours, rows_per_file=4)
    assert sorted(tuple(r) for r in read(spark, ours, df.schema, multi_line=True, keep_empty=True).collect()) == sorted(rows)
    parts = [pd.read_csv(p, sep=sep, keep_default_na=False) for p in sorted((tmp_path / "ours").glob("*.csv"))]
    back = pd.concat(parts).sort_values("k")
    assert len(parts) > 1 and back["a"].tolist() == CELLS + [""]
    theirs = str(tmp_path / "theirs.csv")
    pd.DataFrame(rows[:-1], columns=["k", "a"]).to_csv(theirs, sep=sep, index=False)
    got = {r.k: r.a for r in read(spark, theirs, df.schema, multi_line=True).collect()}
    assert [got[i] or "" for i in range(len(CELLS))] == CELLS


@pytest.mark.parametrize("text", ["k,a\n1,x\n2,y,z\n", "k,a\n1\n", "k,a\nnot a number,x\n", 'k,a\n1,"two\nlines"\n'])
def test_malformed_rows_raise(spark, tmp_path, text):
    path = tmp_path / "bad.csv"
    path.write_text(text)
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_csv(spark, str(path), "k int, a string").collect()


def test_malformed_json_raises_with_its_path(spark, tmp_path):
    (tmp_path / "good.json").write_text('[{"m": {"a": "1"}}]')
    assert files.read_keyed_json(spark, str(tmp_path), "key", ["a"]).collect() == [("m", "1")]
    (tmp_path / "broken.json").write_text('[{"m": {"a": ')
    with pytest.raises(Exception, match="broken.json"):
        files.read_keyed_json(spark, str(tmp_path), "key", ["a"]).collect()


def test_temp_table_releases_the_old_contents(spark):
    first = spark.range(3).toDF("x")
    R.temp_table(first, "t_release")
    R.temp_table(spark.range(5).toDF("x"), "t_release")
    assert not first.is_cached and spark.table("t_release").count() == 5


def test_cache_follows_its_input_and_release_drops(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.range(3).write.parquet(path)
    build = lambda: spark.read.parquet(path)
    spark.conf.set(cache.MODE_CONF, "table")
    try:
        assert cache.cached(spark, ("follow", path), build).count() == 3
        spark.range(7).write.mode("overwrite").parquet(path)
        assert cache.cached(spark, ("follow", path), build).count() == 7
        name, folder = next(v for k, v in cache._STORED.items() if "follow" in k)
        cache.release(spark)
        assert not spark.catalog.tableExists(name)
    finally:
        spark.conf.unset(cache.MODE_CONF)


def test_numbers_are_what_pandas_reads(spark):
    from tablewright.operators import cleaning as C
    cells = ["5", " 5.5 ", "-1e3", ".5", "5.", "inf", "-Infinity", "5d", "5f", "0x1p3", "1_000", "", "nan", "e5", "+7"]
    df = spark.createDataFrame([(c,) for c in cells], "x string")
    got = [r.x for r in C.coerce_numeric(df, ["x"]).collect()]
    want = [None if pd.isna(v) else float(v) for v in pd.to_numeric(pd.Series(cells), errors="coerce")]
    assert got == want


@pytest.mark.parametrize("write,read", [(files.write_csv, files.read_csv), (files.write_tsv, files.read_tsv)])
def test_one_column_keeps_its_missing_rows(spark, tmp_path, write, read):
    rows = [("a",), (None,), ("b",), (None,), (None,)]
    df = spark.createDataFrame(rows, "a string").coalesce(1)
    write(df, str(tmp_path / "t"))
    assert sorted(read(spark, str(tmp_path / "t"), df.schema).collect(), key=str) == sorted(rows, key=str)
    assert sorted(read(spark, str(tmp_path / "t"), df.schema, multi_line=True).collect(), key=str) == sorted(rows, key=str)
    back = pd.concat([pd.read_csv(p, sep="\t") for p in (tmp_path / "t").glob("*.csv")])
    assert back["a"].isna().sum() == 3 and len(back) == 5
    numbers = spark.createDataFrame([(1,), (None,), (3,)], "n int").coalesce(1)
    write(numbers, str(tmp_path / "n"))
    assert sorted(r.n or 0 for r in read(spark, str(tmp_path / "n"), numbers.schema).collect()) == [0, 1, 3]


@pytest.mark.parametrize("text", ["", " \n", "[]x", '[{"a": {}}] {}', '[{"a": {}},]', '[{"a": {}}', '{"a": {}}', '[{"a": 1}]',
                                  '[{"a" {}}]', '[{"a": {"b": 1}} {"c": {}}]'])
def test_what_is_no_keyed_document_raises(spark, tmp_path, text):
    (tmp_path / "one.json").write_text(text)
    with pytest.raises(Exception, match="not a keyed JSON document.*one.json"):
        files.read_keyed_json(spark, str(tmp_path), "key", ["b"]).collect()


def test_keyed_json_entries_are_streamed(spark, tmp_path):
    (tmp_path / "a.json").write_text('\n [ {"x": {"Rating": 8.50, "rating": true, "n": null, "l": [1, "é"], "Rating": 9.10}}, {} ,'
                                     ' {"y": {}, "z": {"n": -1e3, "l": {"k": NaN}}} ] \n')
    (tmp_path / "b.json").write_text("[]")
    got = {r["key"]: (r["Rating"], r["rating"], r["n"], r["l"])
           for r in files.read_keyed_json(spark, str(tmp_path), "key", ["Rating", "rating", "n", "l"]).collect()}
    assert got == {"x": ("9.10", "true", None, '["1", "é"]'), "y": (None,) * 4, "z": (None, None, "-1e3", '{"k": "NaN"}')}
    text = "[{" + ",".join(f'"k{i}": {{"v": {i}}}' for i in range(50_000)) + "}]"
    rows = files._entries(text, "p")
    assert next(rows) == ("k0", {"v": "0"}) and sum(1 for _ in rows) == 49_999
    assert [r for r in files._entries('[{"a": {"b": 1}}, {}]', "p")] == [("a", {"b": "1"})]

"""File sources and sinks round-trip values exactly."""

import os
import tempfile

from tablewright.sources import excel, files


def _tmp():
    return tempfile.mkdtemp(prefix="tablewright-test-")


def test_csv_and_tsv_keep_padding_and_nulls(spark):
    rows = [(" a  ", None, "x,y"), ("", "b\tc", None)]
    df = spark.createDataFrame(rows, "`Country ` string, `Density (per km²)` string, c string")
    for write, read in ((files.write_csv, files.read_csv), (files.write_tsv, files.read_tsv)):
        path = os.path.join(_tmp(), "out")
        write(df, path)
        back = read(spark, path, files.string_schema(df.columns))
        assert back.columns == df.columns
        # Like pandas to_csv / read_csv, an empty cell reads back as missing.
        expected = [(" a  ", None, "x,y"), (None, "b\tc", None)]
        assert sorted(map(tuple, back.collect()), key=str) == sorted(expected, key=str)


def test_keyed_json(spark):
    path = os.path.join(_tmp(), "movies.json")
    with open(path, "w") as f:
        f.write('[{"Up": {"Rating": "PG", "rating": null, "Tomato Score": 98},\n'
                ' "Heat": {"rating": "R", "Gross": "$1,000"}}]')
    df = files.read_keyed_json(spark, path, "Movie")
    rows = {r["Movie"]: r.asDict() for r in df.collect()}
    assert rows["Up"]["Rating"] == "PG" and rows["Up"]["Tomato Score"] == "98"
    assert rows["Heat"]["rating"] == "R" and rows["Heat"]["Rating"] is None


def test_excel_round_trip(spark):
    folder = os.path.join(_tmp(), "books")
    df = spark.createDataFrame([("A & B", "1"), (None, "2"), ("<c>", None)], "name string, n string")
    excel.write_excel(df.repartition(2), folder, rows_per_file=2, sheet="Data")
    back = excel.read_excel(spark, folder, ["name", "n"])
    assert sorted(back.collect(), key=str) == sorted(df.collect(), key=str)
    sheets = excel.list_sheets(spark, folder).select("sheet_name").distinct().collect()
    assert [r.sheet_name for r in sheets] == ["Data"]


def _xlsx_with_shared_strings(path):
    import zipfile
    m = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    r = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    rel = "http://schemas.openxmlformats.org/package/2006/relationships"
    parts = {
        "xl/workbook.xml": f'<workbook xmlns="{m}" xmlns:r="{r}"><sheets>'
                           f'<sheet name="First" sheetId="1" r:id="rId7"/>'
                           f'<sheet name="Second" sheetId="2" r:id="rId8"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{rel}">'
                                      '<Relationship Id="rId7" Type="x" Target="worksheets/s1.xml"/>'
                                      '<Relationship Id="rId8" Type="x" Target="/xl/worksheets/s2.xml"/>'
                                      '</Relationships>',
        "xl/sharedStrings.xml": f'<sst xmlns="{m}"><si><t>Country</t></si><si><t>Pop</t></si>'
                                f'<si><t>Flag</t></si><si><r><t>Nige</t></r><r><t>ria</t></r></si>'
                                f'</sst>',
        "xl/worksheets/s1.xml": f'<worksheet xmlns="{m}"><sheetData>'
                                '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c>'
                                '<c r="C1" t="s"><v>2</v></c></row>'
                                '<row r="2"><c r="A2" t="s"><v>3</v></c><c r="B2"><v>218.5</v></c>'
                                '<c r="C2" t="b"><v>1</v></c></row>'
                                '<row r="3"><c r="C3" t="str"><v>x</v></c></row>'
                                '</sheetData></worksheet>',
        "xl/worksheets/s2.xml": f'<worksheet xmlns="{m}"><sheetData/></worksheet>',
    }
    with zipfile.ZipFile(path, "w") as z:
        for name, text in parts.items():
            z.writestr(name, text)


def test_excel_reader_shared_strings_types_and_gaps(spark):
    folder = _tmp()
    _xlsx_with_shared_strings(os.path.join(folder, "book.xlsx"))
    rows = excel.read_excel(spark, folder, ["country", "pop", "flag"]).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(
        [("Nigeria", "218.5", "True"), (None, None, "x")], key=str)
    names = sorted((r.sheet_index, r.sheet_name) for r in excel.list_sheets(spark, folder).collect())
    assert names == [(0, "First"), (1, "Second")]


def test_keyed_json_many_files(spark):
    folder = _tmp()
    for i in range(3):
        with open(os.path.join(folder, f"part{i}.json"), "w") as f:
            f.write('[{"M%d": {"a": "%d"}, "N%d": {"b": true}}]' % (i, i, i))
    df = files.read_keyed_json(spark, folder, "Movie", ["a", "b"])
    got = sorted((r.Movie, r.a, r.b) for r in df.collect())
    assert got == [("M0", "0", None), ("M1", "1", None), ("M2", "2", None),
                   ("N0", None, "true"), ("N1", None, "true"), ("N2", None, "true")]


def test_writers_bound_rows_per_file(spark):
    df = spark.range(0, 25).selectExpr("concat('M', CAST(id AS string)) AS Movie",
                                       "CAST(id AS string) AS a").coalesce(1)
    jpath = os.path.join(_tmp(), "json")
    files.write_keyed_json(df, jpath, "Movie", rows_per_file=10)
    docs = spark.read.text(jpath, wholetext=True).collect()
    assert len(docs) == 3
    back = files.read_keyed_json(spark, jpath, "Movie", ["a"])
    assert sorted(r.a for r in back.collect()) == sorted(str(i) for i in range(25))
    xpath = os.path.join(_tmp(), "xlsx")
    excel.write_excel(df, xpath, rows_per_file=10)
    assert len([f for f in os.listdir(xpath) if f.endswith(".xlsx")]) == 3
    assert excel.read_excel(spark, xpath, ["Movie", "a"]).count() == 25


def test_excel_columns_from_header(spark):
    folder = os.path.join(_tmp(), "books")
    df = spark.createDataFrame([("a", "1"), ("b", None)], "`Country ` string, `2022 Population` string")
    excel.write_excel(df, folder)
    back = excel.read_excel(spark, folder)
    assert back.columns == ["Country ", "2022 Population"]
    assert sorted(map(tuple, back.collect()), key=str) == sorted([("a", "1"), ("b", None)], key=str)

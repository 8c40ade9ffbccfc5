"""Round trips through every file format the reference loads or saves.

Each query writes a table derived from the driver's data to a fresh folder
under the session's shared folder, reads it back with the source under test
and returns what was read; the oracle is the table itself.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import hr as hr_ops
from ..session import scratch_path
from ..sources import excel, files, fixtures
from ..sources.tables import table
from . import hr, notebook


def countries_load(spark, sf_dir):
    raw = notebook.countries_raw(spark, sf_dir)
    path = scratch_path(spark, "countries_csv")
    files.write_csv(raw, path)
    return files.read_csv(spark, path, files.string_schema(raw.columns))


def txt_round_trip(spark, sf_dir):
    raw = notebook.countries_raw(spark, sf_dir)
    path = scratch_path(spark, "countries_txt")
    files.write_tsv(raw, path)
    return files.read_tsv(spark, path, files.string_schema(raw.columns))


def documents_round_trip(write, read):
    """The given documents, whose texts hold newlines and quotes, through a text file."""
    def run(spark, sf_dir):
        docs = table(spark, sf_dir, "documents")
        path = scratch_path(spark, "documents_text")
        write(docs, path, rows_per_file=20_000)
        return read(spark, path, docs.schema, multi_line=True, keep_empty=True)
    return run


def population_workbooks(spark, sf_dir) -> str:
    raw = notebook.population_raw(spark, sf_dir)
    path = scratch_path(spark, "population_xlsx")
    excel.write_excel(raw, path)
    return path


def population_load(spark, sf_dir):
    raw = notebook.population_raw(spark, sf_dir)
    return excel.read_excel(spark, population_workbooks(spark, sf_dir), raw.columns)


def population_sheets(spark, sf_dir):
    return (excel.list_sheets(spark, population_workbooks(spark, sf_dir))
            .select("sheet_index", "sheet_name").distinct())


def movies_load(spark, sf_dir):
    raw = notebook.movies_raw(spark, sf_dir)
    path = scratch_path(spark, "movies_json")
    files.write_keyed_json(raw, path, "Movie")
    back = files.read_keyed_json(spark, path, "Movie", notebook.MOVIE_KEYS[1:])
    # "Rating" / "rating" keep their positions; name them as the recipe does.
    return back.toDF(*fixtures.fixture(spark, sf_dir, "movies_raw").columns)


def saved(name):
    def run(spark, sf_dir):
        df = getattr(notebook, name)(spark, sf_dir)
        path = scratch_path(spark, f"cleaned_{name}")
        files.write_csv(df, path)
        return files.read_csv(spark, path, df.schema)
    return run


# The notebook's output file names.
SAVED_FILES = {"countries": "cleaned_countries.csv", "population": "cleaned_population.csv",
               "movies": "cleaned_movies.csv"}


def save_clean(spark, sf_dir):
    """Write the three cleaned datasets as CSV (no index) and report what reads back."""
    parts = []
    for name, file_name in SAVED_FILES.items():
        df = getattr(notebook, name)(spark, sf_dir)
        path = f"{scratch_path(spark, 'save_clean')}/{file_name}"
        files.write_csv(df, path)
        back = files.read_csv(spark, path, df.schema)
        parts.append(back.agg(F.lit(file_name).alias("file"),
                              F.count(F.lit(1)).alias("rows"),
                              F.lit(len(back.columns)).cast("bigint").alias("columns")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def hr_csv_landing(spark, sf_dir):
    """The HR flow from a CSV import: all-text landing table -> clean -> derive."""
    raw = hr.raw_table(spark, sf_dir)
    path = scratch_path(spark, "hr_data_csv")
    files.write_csv(raw, path)
    landed = files.read_csv(spark, path, files.string_schema(raw.columns))
    return hr_ops.derive(hr_ops.clean(landed), hr.AS_OF)


REPORTS = {
    "countries_load": countries_load,
    "txt_round_trip": txt_round_trip,
    "documents_csv_round_trip": documents_round_trip(files.write_csv, files.read_csv),
    "documents_tsv_round_trip": documents_round_trip(files.write_tsv, files.read_tsv),
    "population_load": population_load,
    "population_sheets": population_sheets,
    "movies_load": movies_load,
    "countries_saved": saved("countries"),
    "population_saved": saved("population"),
    "movies_saved": saved("movies"),
    "hr_csv_landing": hr_csv_landing,
    "save_clean": save_clean,
}

ORACLE = {
    "countries_load": fixtures.duckdb_with(["countries_raw"], "SELECT * FROM countries_raw"),
    "txt_round_trip": fixtures.duckdb_with(["countries_raw"], "SELECT * FROM countries_raw"),
    "documents_csv_round_trip": "SELECT * FROM documents",
    "documents_tsv_round_trip": "SELECT * FROM documents",
    "population_load": fixtures.duckdb_with(["population_raw"], "SELECT * FROM population_raw"),
    "population_sheets": fixtures.duckdb_with(
        ["population_raw"], "SELECT DISTINCT 0 AS sheet_index, 'Sheet1' AS sheet_name "
                            "FROM population_raw"),
    "movies_load": fixtures.duckdb_with(["movies_raw"], "SELECT * FROM movies_raw"),
    "countries_saved": notebook.oracle_sql("countries_clean"),
    "population_saved": notebook.oracle_sql("population_clean"),
    "movies_saved": notebook.oracle_sql("movies_clean"),
    "hr_csv_landing": hr.with_emp("SELECT * FROM emp"),
    "save_clean": fixtures.duckdb_with(
        notebook.RECIPES,
        " UNION ALL ".join(
            f"SELECT '{f}' AS file, COUNT(*) AS rows, CAST({n} AS BIGINT) AS columns FROM {t}"
            for f, n, t in (("cleaned_countries.csv", 2, "countries_clean"),
                            ("cleaned_population.csv", 5, "population_clean"),
                            ("cleaned_movies.csv", 6, "movies_clean"))),
        extra=notebook.ORACLE_CTES),
}


def queries():
    return {key: (fn, ORACLE[key]) for key, fn in REPORTS.items()}

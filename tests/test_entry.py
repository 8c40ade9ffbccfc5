"""Driver contract, and every registered query against its DuckDB oracle at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as entry
from scripts.oracle_check import rows_of, strict
from tablewright.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["department", "total_employees", "active_employees",
                          "terminated_employees", "attrition_rate_percentage"]
    assert df.count() > 0


def test_oracle_keys_are_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, SF)
    rows = df.collect()
    rel = con.sql(entry.oracle_sql()[key])
    assert sorted(df.columns) == sorted(rel.columns)
    stypes = {f.name: strict(f.dataType.simpleString()) for f in df.schema.fields}
    dtypes = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert stypes == dtypes
    assert rows_of(df.columns, rows) == rows_of(rel.columns, rel.fetchall())


def test_table_materialization_gives_same_results(spark):
    from tablewright.plans import cache
    keys = ["hr_dept_attrition", "profit_by_product", "population_clean", "ledger_balance"]
    before = {k: sorted(entry.queries()[k](spark, SF).collect()) for k in keys}
    spark.conf.set(cache.MODE_CONF, "table")
    try:
        after = {k: sorted(entry.queries()[k](spark, SF).collect()) for k in keys}
    finally:
        spark.conf.unset(cache.MODE_CONF)
    assert before == after


def test_workers_need_no_package_on_their_path(tmp_path):
    """Python-worker functions travel by value: the driver may run from any folder."""
    import os
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = (
        "import sys; sys.path.insert(0, %r)\n"
        "from pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false')"
        ".getOrCreate()\n"
        "import __spark_entry__ as e\n"
        "print('ROWS', e.queries()['ledger_outcomes'](s, %r).count())\n" % (repo, SF))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env,
                         capture_output=True, text=True, timeout=600)
    assert "ROWS 1000" in out.stdout, out.stderr[-2000:]


def test_release_keeps_results(spark):
    from tablewright.plans import cache
    keys = ["hr_tenure_rank", "sal_rank_by_job", "population_clean"]
    first = {k: sorted(entry.queries()[k](spark, SF).collect()) for k in keys}
    built = entry.queries()["hr_tenure_rank"](spark, SF)
    cache.release(spark)
    assert sorted(built.collect()) == first["hr_tenure_rank"]
    again = {k: sorted(entry.queries()[k](spark, SF).collect()) for k in keys}
    assert again == first


def test_command_line_lists_and_prints_sql(capsys):
    from tablewright.__main__ import main
    assert main(["list"]) == 0
    listed = capsys.readouterr().out.split()
    assert sorted(listed) == sorted(entry.queries())
    assert main(["sql", "hr_kpi"]) == 0
    assert "average_tenure_years" in capsys.readouterr().out

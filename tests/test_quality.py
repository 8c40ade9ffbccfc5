"""Profile of a table: exact counts of repeated rows, whatever their fingerprints."""

import math
import random
from collections import Counter

import __spark_entry__ as entry
from tablewright.operators import quality as Q
from tablewright.plans import cache

SF = "/root/testdata/sf0.001"


def one(df):
    return Q.profile(df).first().asDict()


def test_profile_equals_plain_counting(spark):
    rnd = random.Random(5)
    rows = [(rnd.choice([None, 1, 2]), rnd.choice([None, "", "a", "b"]), rnd.choice([None, 0.5, 2.0]))
            for _ in range(400)] + [(i, "x", None) for i in range(100)]
    df = spark.createDataFrame(rows, "`a b` int, s string, `x.y` double").repartition(7)
    assert one(df) == {
        "rows": 500, "columns": 3, "missing_values": sum(v is None for r in rows for v in r),
        "duplicate_rows": sum(n - 1 for n in Counter(rows).values())}
    assert Q.duplicate_row_count(df).first()[0] == one(df)["duplicate_rows"]


def test_profile_counts_rows_that_grouping_calls_equal(spark):
    rows = [(0.0, [1, None]), (-0.0, [1, None]), (math.nan, [None, 1]), (math.nan, [None, 1]),
            (None, [1]), (None, None), (0.0, [None, 1])]
    df = spark.createDataFrame(rows, "x double, a array<int>")
    assert one(df)["duplicate_rows"] == df.count() - df.distinct().count() == 2


def test_profile_survives_colliding_fingerprints(spark):
    # The hash skips NULL elements of arrays, so these different rows share both hashes.
    rows = [([1, None, 2],), ([None, 1, 2],), ([1, 2, None],), ([1, 2, None],)]
    df = spark.createDataFrame(rows, "a array<int>")
    assert one(df)["duplicate_rows"] == 1


def test_profile_of_an_empty_table(spark):
    df = spark.createDataFrame([], "a int, b string")
    assert one(df) == {"rows": 0, "columns": 2, "missing_values": 0, "duplicate_rows": 0}


def test_first_grouping_moves_no_cells(spark):
    df = spark.range(1000).selectExpr("id", "repeat(string(id), 50) AS wide")
    text = Q.profile(df)._jdf.queryExecution().executedPlan().toString()
    main = "".join(x for x in text.splitlines() if not x.lstrip().startswith(":"))
    assert "hashpartitioning(_h1" in main and "hashpartitioning(_c" not in main


def test_salary_join_is_planned_once(spark):
    for key in ("emp_cte_avg", "emp_top3_salary"):
        df = entry.queries()[key](spark, SF)
        text = df._jdf.queryExecution().optimizedPlan().toString()
        assert "InMemoryRelation" in text, key
        assert "Join Inner, (EmployeeID" not in text.split("InMemoryRelation")[0], key


def test_shared_tables_are_written_beyond_one_machine():
    assert [cache.default_mode(m) for m in ("local", "local[8]", "local[*]")] == ["cache"] * 3
    assert [cache.default_mode(m) for m in ("local-cluster[2,1,1024]", "spark://h:1", "yarn", "")] == ["table"] * 4

"""HR derivations at their edges: dates, status, rounding, thresholds, bands."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tablewright.functions import metrics as M
from tablewright.operators import hr as H
from tablewright.plans import hr as HR

AS_OF = "2001-02-28 12:00:00"
RAW_COLS = ["id", "first_name", "last_name", "birthdate", "gender", "race", "department",
            "jobtitle", "location", "hire_date", "termdate", "location_city", "location_state"]


def raw(spark, rows):
    full = [(str(i), "f", "l", b, "g", "r", "d", "j", "loc", h, t, "c", "s")
            for i, (b, h, t) in enumerate(rows)]
    return spark.createDataFrame(full, ", ".join(f"{c} string" for c in RAW_COLS))


def test_clean_parses_and_rejects(spark):
    rows = [("  1980-02-29 ", "1999-03-01", "2000-01-05 00:00:00 UTC"),
            ("not-a-date", "", ""), (None, None, None)]
    out = H.clean(raw(spark, rows)).orderBy("id").collect()
    assert out[0].birthdate == dt.date(1980, 2, 29)
    assert out[0].termdate == dt.datetime(2000, 1, 5)
    assert out[1].birthdate is None and out[1].hire_date is None and out[1].termdate is None
    assert out[2].birthdate is None


def test_age_status_tenure_edges(spark):
    rows = [
        ("1980-02-29", "2000-02-28", None),               # Feb 29 birthday reached on Feb 28
        ("1981-02-28", "1999-03-01", "2001-02-28 12:00:00"),  # birthday today; term == now
        ("1981-03-01", "2000-03-01", "2001-02-28 12:00:01"),  # day before birthday; term future
        ("1990-01-01", "2000-06-02", "2000-06-01 00:00:00"),  # hired after leaving
        (None, None, None),
    ]
    out = H.derive(H.clean(raw(spark, rows)), AS_OF).orderBy("id").collect()
    assert [r.age for r in out] == [21, 20, 19, 11, None]
    assert [r.employee_status for r in out] == [
        "Active", "Terminated", "Active", "Terminated", "Active"]
    assert out[0].tenure_years == 1       # active: to now
    assert out[1].tenure_years == 1       # terminated: to termdate
    assert out[3].tenure_years == -1      # negative tenure kept
    assert out[4].tenure_years is None


def test_rate_rounds_half_up_and_thresholds(spark):
    df = spark.createDataFrame([(3, 60000), (1, 200), (10, 100), (1999, 10000), (20, 100)],
                               "n long, d long")
    got = [r.p for r in df.select(M.pct("n", "d").alias("p")).collect()]
    assert got == [Decimal("0.01"), Decimal("0.50"), Decimal("10.00"), Decimal("19.99"),
                   Decimal("20.00")]
    tiers = df.select(M.classify(M.pct("n", "d"), HR.RISK_TIERS, HR.RISK_OTHER).alias("t"))
    assert [r.t for r in tiers.collect()] == [
        "Low Risk", "Low Risk", "Medium Risk", "Medium Risk", "High Risk"]


def test_recommendation_branches(spark):
    df = spark.createDataFrame(
        [(Decimal("25.00"), Decimal("3.00")), (Decimal("20.00"), Decimal("5.00")),
         (Decimal("19.99"), Decimal("9.00")), (Decimal("9.99"), Decimal("1.00")),
         (Decimal("30.00"), None)],
        "attrition_rate_percentage decimal(10,2), average_tenure_years decimal(10,2)")
    out = [r.hr_recommendation for r in
           HR._post_spark(df, ("recommend", "hr_recommendation")).collect()]
    assert out == [HR.REC_PRIORITY, HR.REC_ACTION, HR.REC_MONITOR, HR.REC_MAINTAIN,
                   HR.REC_MAINTAIN]


def test_bands(spark):
    df = spark.createDataFrame([(v,) for v in (-2, 0, 1, 3, 4, 10, 11, None)], "t int")
    got = [r.b for r in df.select(M.band("t", M.TENURE_BANDS).alias("b")).collect()]
    assert got == ["Less than 1 Year", "Less than 1 Year", "1-3 Years", "1-3 Years",
                   "4-6 Years", "7-10 Years", "More than 10 Years", "Unknown"]
    ages = spark.createDataFrame([(v,) for v in (24, 25, 54, 55, None)], "a int")
    got = [r.b for r in ages.select(M.band("a", M.AGE_BANDS).alias("b")).collect()]
    assert got == ["Under 25", "25-34", "45-54", "55 and Above", "Unknown"]


def test_average_half_up(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (2,), (2,), (2,), (2,), (2,)], "x int")
    # 15 / 8 = 1.875 -> 1.88
    assert df.agg(M.avg_dec("x").alias("a")).first().a == Decimal("1.88")
    assert df.agg(M.avg_int("x").alias("a")).first().a == 1

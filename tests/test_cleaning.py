"""Notebook cleaning steps on hand-made edge rows."""

from pyspark.sql import functions as F

from tablewright.operators import cleaning as C
from tablewright.operators import quality as Q
from tablewright.plans import notebook as NB


def test_column_names():
    assert C.clean_column_name(" Density (per km²) ") == "density_per_km2"
    assert C.clean_column_name("Density (per kmÂ²)") == "density_per_km2"
    assert C.clean_column_name("2022 Population") == "2022_population"
    assert C.clean_column_name("Growth-Rate/Year") == "growth_rate_year"


def test_strip_all_unicode_whitespace(spark):
    df = spark.createDataFrame([("\t a b \n",), (" ",), (None,)], "x string")
    assert [r.x for r in C.strip_text(df).collect()] == ["a b", "", None]


def test_to_number_and_sentinels(spark):
    vals = ["1,000", "N.A.", "", "nan", "inf", "-1", "-1.0", "unkown", "None", "12.5", None]
    df = spark.createDataFrame([(v,) for v in vals], "x string")
    nums = [r.x for r in C.coerce_numeric(df, ["x"]).collect()]
    assert nums[:4] == [None, None, None, None]
    assert nums[4] == float("inf") and nums[5] == -1.0 and nums[9] == 12.5
    kept = [r.x for r in C.sentinels_to_null(df).collect()]
    assert kept == ["1,000", "N.A.", "", None, "inf", None, "-1.0", None, "None", "12.5", None]
    cur = df.select(C.parse_currency(F.lit("$1,234")).alias("g")).first().g
    assert cur == 1234.0


def test_merge_same_name_first_non_missing(spark):
    df = spark.createDataFrame([("a", None, "x"), (None, "b", "y"), (None, None, "z")],
                               "Rating string, rating string, Title string")
    out = C.merge_same_name(C.clean_column_names(df))
    assert out.columns == ["rating", "title"]
    assert [r.rating for r in out.collect()] == ["a", "b", None]


def test_synonym_merge_before_sentinels(spark):
    raw = spark.createDataFrame(
        [("M1", None, None, "g", "-1", "45", "60", "$1,000"),
         ("M2", "PG", None, "g", None, "45", "-1", "unknown")],
        ", ".join(f"`{c}` string" for c in ["Movie", "Rating", "rating", "Genre", "Popcorn Score",
                                            "popcornscore", "Tomato Score", "Gross"]))
    raw = raw.toDF(*NB.MOVIE_KEYS)
    out = {r.movie: r for r in NB.clean_movies(raw).collect()}
    # "-1" in the first column hides 45 in the second; then it becomes missing -> median.
    assert out["M1"].popcorn_score == out["M2"].popcorn_score == 45.0
    assert out["M1"].rating == "Unrated"
    assert out["M2"].tomato_score == 60.0 and out["M2"].gross == 1000.0


def test_exact_median_even_odd_and_empty(spark):
    even = spark.createDataFrame([(float(v),) for v in (4, 1, 3, 2)], "x double")
    assert C.exact_median(even, "x").first().median == 2.5
    odd = spark.createDataFrame([(float(v),) for v in (5, 1, 5, 2, 9)], "x double")
    assert C.exact_median(odd, "x").first().median == 5.0
    empty = spark.createDataFrame([(None,), (None,)], "x double")
    filled = C.fill_median(empty, ["x"]).collect()
    assert [r.x for r in filled] == [None, None]


def test_quality_counts(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "k int, v string")
    assert Q.duplicate_row_count(df).first().duplicate_rows == 1
    nc = Q.null_counts(df, total="total").first()
    assert (nc.total, nc.k, nc.v) == (3, 0, 1)
    assert [r.k for r in Q.duplicate_keys(df, ["k"]).collect()] == [1]


def test_approximate_median_option(spark):
    rows = [(i, float(i)) for i in range(1, 1002)] + [(0, None)]
    df = spark.createDataFrame(rows, "id int, x double")
    exact = C.fill_median(df, ["x"]).filter("id = 0").first().x
    approx = C.fill_median(df, ["x"], approximate=True).filter("id = 0").first().x
    assert exact == 501.0
    assert abs(approx - 501.0) <= 1001 / 10000 + 1

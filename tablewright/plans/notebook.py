"""The pandas notebooks (weeks 21-22): clean three datasets, filter, group, summarize.

Order of steps follows the notebook, because it changes results (a sentinel
in the first of two merged columns hides a good value in the second; rows
are de-duplicated before medians are taken). Missing values are true NULLs
here: the notebook turns missing text into the string "nan" before counting
and forgets to restore it for some columns; this library follows the stated
purpose instead (see README).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.metrics import mean, sum_decimal
from ..operators import cleaning as C
from ..operators import quality as Q
from ..operators import stats as S
from ..sources import fixtures
from .cache import cached

# The JSON keys of one movie, in file order ("Rating" and "rating" both occur).
MOVIE_KEYS = ["Movie", "Rating", "rating", "Genre", "Popcorn Score", "popcornscore",
              "Tomato Score", "Gross"]

SCORE_COLUMNS = ["imdb_metascore", "popcorn_score", "tomato_score"]
REGION_PATTERN = "SUB-SAHARAN AFRICA"
LARGE_POPULATION = 100_000_000
HIGH_TOMATO = 80


# ------------------------------------------------------------ raw inputs

def countries_raw(spark, sf_dir):
    return fixtures.fixture(spark, sf_dir, "countries_raw")


def population_raw(spark, sf_dir):
    return fixtures.fixture(spark, sf_dir, "population_raw")


def movies_raw(spark, sf_dir):
    """Movies with the JSON key names (the recipe's rating_a / rating_b by position)."""
    return fixtures.fixture(spark, sf_dir, "movies_raw").toDF(*MOVIE_KEYS)


# ------------------------------------------------------------- pipelines

def clean_countries(raw: DataFrame) -> DataFrame:
    df = C.strip_text(C.clean_column_names(raw))
    df = df.distinct()
    return C.missing_to_text(df, ["region"], "Unknown")


def clean_population(raw: DataFrame) -> DataFrame:
    df = C.strip_text(C.clean_column_names(raw))
    df = df.distinct()
    df = C.coerce_numeric(df, C.columns_with_keywords(df))
    df = C.fill_median(df, C.numeric_columns(df))
    return C.missing_to_text(df, C.text_columns(df), "Unknown")


def clean_movies(raw: DataFrame) -> DataFrame:
    df = C.merge_same_name(C.clean_column_names(raw))
    df = C.merge_synonym(df, "popcorn_score", "popcornscore")
    df = C.merge_synonym(df, "tomato_score", "tomatoscore")
    df = C.strip_text(df)
    df = C.sentinels_to_null(df)
    if "gross" in df.columns:
        df = df.withColumn("gross", C.parse_currency(F.col("gross")))
    df = C.coerce_numeric(df, SCORE_COLUMNS)
    df = df.distinct()
    df = C.fill_text(df, {"genre": "Unknown", "rating": "Unrated"})
    return C.fill_median(df, C.numeric_columns(df))


def countries(spark, sf_dir):
    return cached(spark, ("countries", sf_dir), lambda: clean_countries(countries_raw(spark, sf_dir)))


def population(spark, sf_dir):
    return cached(spark, ("population", sf_dir),
                  lambda: clean_population(population_raw(spark, sf_dir)))


def movies(spark, sf_dir):
    return cached(spark, ("movies", sf_dir), lambda: clean_movies(movies_raw(spark, sf_dir)))


def ledger_txns(spark, sf_dir):
    return fixtures.fixture(spark, sf_dir, "ledger_txns")


# --------------------------------------------------------------- reports

def quality_before_after(spark, sf_dir) -> DataFrame:
    """Shape, missing cells and duplicate rows of each dataset before and after cleaning."""
    parts = []
    for name, raw, clean in (
            ("countries", C.clean_column_names(countries_raw(spark, sf_dir)),
             countries(spark, sf_dir)),
            ("population", C.clean_column_names(population_raw(spark, sf_dir)),
             population(spark, sf_dir)),
            ("movies", C.merge_same_name(C.clean_column_names(movies_raw(spark, sf_dir))),
             movies(spark, sf_dir))):
        for stage, df in (("before", raw), ("after", clean)):
            parts.append(Q.profile(df).select(
                F.lit(name).alias("dataset"), F.lit(stage).alias("stage"),
                "rows", "columns", "missing_values", "duplicate_rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def quality_missing(spark, sf_dir) -> DataFrame:
    """Missing cells per column of each dataset, before and after cleaning."""
    parts = []
    for name, raw, clean in (
            ("countries", C.clean_column_names(countries_raw(spark, sf_dir)),
             countries(spark, sf_dir)),
            ("population", C.clean_column_names(population_raw(spark, sf_dir)),
             population(spark, sf_dir)),
            ("movies", C.merge_same_name(C.clean_column_names(movies_raw(spark, sf_dir))),
             movies(spark, sf_dir))):
        for stage, df in (("before", raw), ("after", clean)):
            parts.append(Q.null_counts_long(df, name, df.columns).select(
                F.col("TableName").alias("dataset"), F.lit(stage).alias("stage"),
                F.col("ColumnName").alias("column_name"), F.col("NullRows").alias("missing")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


TXN_NUMERIC = ["account_id", "event_id", "amount", "network_choice"]


def eda_population(df: DataFrame) -> DataFrame:
    pop = F.col("2022_population")
    return df.agg(
        F.countDistinct("country").alias("total_countries"),
        F.sum(pop).alias("total_2022_population"),
        F.format_number(F.sum(pop), 0).alias("total_2022_population_text"),
        # idxmax: the largest value; ties go to the smallest country name.
        F.min_by("country", F.when(pop.isNotNull(), F.struct(-pop, F.col("country"))))
        .alias("most_populated_country"))


REPORTS = {
    "countries_clean": lambda s, d: countries(s, d),
    "population_clean": lambda s, d: population(s, d),
    "movies_clean": lambda s, d: movies(s, d),
    "quality_before_after": quality_before_after,
    "quality_missing": quality_missing,
    "countries_sub_saharan": lambda s, d: countries(s, d).filter(F.coalesce(
        F.lower(F.col("region")).contains(REGION_PATTERN.lower()), F.lit(False))),
    "population_large": lambda s, d: (
        population(s, d).filter(F.col("2022_population") > LARGE_POPULATION)
        .select("country", "continent", "2022_population", "density_per_km2")
        .orderBy(F.col("2022_population").desc_nulls_last())),
    "movies_high_tomato": lambda s, d: (
        movies(s, d).filter(F.col("tomato_score") >= HIGH_TOMATO)
        .select("movie", "rating", "tomato_score", "popcorn_score")
        .orderBy(F.col("tomato_score").desc_nulls_last(), F.col("movie").asc())
        .limit(10)),
    "countries_by_region": lambda s, d: (
        countries(s, d).filter(F.col("region").isNotNull()).groupBy("region")
        .agg(F.count(F.lit(1)).alias("number_of_countries"))
        .orderBy(F.col("number_of_countries").desc())),
    "population_by_continent": lambda s, d: (
        population(s, d).filter(F.col("continent").isNotNull()).groupBy("continent")
        .agg(F.sum("2022_population").alias("total_2022_population"),
             mean("2022_population").alias("average_2022_population"),
             mean("density_per_km2").alias("average_density"),
             F.count("country").alias("number_of_countries"))
        .orderBy(F.col("total_2022_population").desc_nulls_last())),
    "movies_by_rating": lambda s, d: (
        movies(s, d).filter(F.col("rating").isNotNull()).groupBy("rating")
        .agg(F.count("movie").alias("number_of_movies"),
             mean("tomato_score").alias("average_tomato_score"),
             mean("popcorn_score").alias("average_popcorn_score"),
             mean("gross").alias("average_gross"))
        .orderBy(F.col("number_of_movies").desc())),
    "eda_countries": lambda s, d: countries(s, d).agg(
        F.countDistinct("country").alias("total_countries"),
        F.countDistinct("region").alias("total_regions")),
    "eda_population": lambda s, d: eda_population(population(s, d)),
    "eda_movies": lambda s, d: movies(s, d).agg(
        F.countDistinct("movie").alias("total_movies"),
        F.bround(F.avg("tomato_score"), 2).alias("average_tomato_score"),
        F.bround(F.avg("popcorn_score"), 2).alias("average_popcorn_score")),
    "txn_head": lambda s, d: ledger_txns(s, d).orderBy("ts", "event_id").limit(5),
    "txn_describe": lambda s, d: S.describe(ledger_txns(s, d), TXN_NUMERIC),
    "txn_totals": lambda s, d: ledger_txns(s, d).agg(
        sum_decimal("amount").alias("total_amount"),
        mean("amount").alias("average_amount"),
        F.max("amount").alias("highest_amount"),
        F.min("amount").alias("lowest_amount")),
}


# --------------------------------------------------------------- the oracle

WS = C.PY_WHITESPACE


def _s(col: str) -> str:
    return f"trim({col}, '{WS}')"


def _num(expr: str) -> str:
    pattern = C.NUMBER.replace("(?i)", "")
    return (f"CASE WHEN regexp_matches(lower({expr}), '{pattern}') "
            f"THEN TRY_CAST({expr} AS DOUBLE) END")


def _median(table: str, col: str) -> str:
    return (f"(SELECT (min(v) + max(v)) / 2 FROM (SELECT v, row_number() OVER (ORDER BY v) "
            f"AS rn, count(*) OVER () AS n FROM (SELECT {col} AS v FROM {table} "
            f"WHERE {col} IS NOT NULL) x) y WHERE rn IN ((n + 1) // 2, n // 2 + 1))")


def _sentinel(col: str) -> str:
    texts = ", ".join(f"'{t}'" for t in C.MISSING_TEXTS)
    return f"CASE WHEN {col} IN ({texts}) THEN NULL ELSE {col} END"


def _unknown(col: str) -> str:
    return f"CASE WHEN {col} IS NULL OR {col} = 'nan' THEN 'Unknown' ELSE {col} END"


ORACLE_CTES = f"""
c_strip AS (SELECT {_s('"Country "')} AS country, {_s('"Region"')} AS region FROM countries_raw),
c_dedup AS (SELECT DISTINCT * FROM c_strip),
countries_clean AS (SELECT country, {_unknown('region')} AS region FROM c_dedup),
p_strip AS (SELECT {_s('"Country"')} AS country, {_s('"Continent"')} AS continent,
                   {_s('"2022 Population"')} AS p, {_s('"Density (per km²)"')} AS dens,
                   {_s('"Rank"')} AS rnk FROM population_raw),
p_dedup AS (SELECT DISTINCT * FROM p_strip),
p_num AS (SELECT country, continent, {_num('p')} AS p, {_num('dens')} AS dens,
                 {_num('rnk')} AS rnk FROM p_dedup),
population_clean AS (
  SELECT {_unknown('country')} AS country, {_unknown('continent')} AS continent,
         coalesce(p, {_median('p_num', 'p')}) AS "2022_population",
         coalesce(dens, {_median('p_num', 'dens')}) AS density_per_km2,
         coalesce(rnk, {_median('p_num', 'rnk')}) AS rank
  FROM p_num),
m_merge AS (SELECT "Gross" AS gross, "Genre" AS genre, "Movie" AS movie,
                   coalesce("Popcorn Score", popcornscore) AS popcorn_score,
                   coalesce(rating_a, rating_b) AS rating, "Tomato Score" AS tomato_score
            FROM movies_raw),
m_strip AS (SELECT {_s('gross')} AS gross, {_s('genre')} AS genre, {_s('movie')} AS movie,
                   {_s('popcorn_score')} AS popcorn_score, {_s('rating')} AS rating,
                   {_s('tomato_score')} AS tomato_score FROM m_merge),
m_null AS (SELECT {_sentinel('gross')} AS gross, {_sentinel('genre')} AS genre,
                  {_sentinel('movie')} AS movie, {_sentinel('popcorn_score')} AS popcorn_score,
                  {_sentinel('rating')} AS rating, {_sentinel('tomato_score')} AS tomato_score
           FROM m_strip),
m_num AS (SELECT {_num("replace(replace(gross, '$', ''), ',', '')")} AS gross, genre, movie,
                 {_num('popcorn_score')} AS popcorn_score, rating,
                 {_num('tomato_score')} AS tomato_score FROM m_null),
m_dedup AS (SELECT DISTINCT * FROM m_num),
movies_clean AS (
  SELECT coalesce(gross, {_median('m_dedup', 'gross')}) AS gross,
         coalesce(genre, 'Unknown') AS genre, movie,
         coalesce(popcorn_score, {_median('m_dedup', 'popcorn_score')}) AS popcorn_score,
         coalesce(rating, 'Unrated') AS rating,
         coalesce(tomato_score, {_median('m_dedup', 'tomato_score')}) AS tomato_score
  FROM m_dedup),
txns AS (SELECT * FROM ledger_txns)"""


def _dup(table: str) -> str:
    return (f"(SELECT CAST((SELECT COUNT(*) FROM {table}) - COUNT(*) AS BIGINT) "
            f"FROM (SELECT DISTINCT * FROM {table}) g)")


def _summary(dataset: str, before: str, after: str, cols_before: list[str],
             cols_after: list[str]) -> str:
    def missing(t, cols):
        cells = " + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in cols)
        return f"(SELECT CAST(SUM({cells}) AS BIGINT) FROM {t})"
    return " UNION ALL ".join(
        f"SELECT '{dataset}' AS dataset, '{stage}' AS stage, (SELECT COUNT(*) FROM {t}) AS rows, "
        f"CAST({len(cols)} AS BIGINT) AS columns, {missing(t, cols)} AS missing_values, "
        f"{_dup(t)} AS duplicate_rows"
        for stage, t, cols in (("before", before, cols_before), ("after", after, cols_after)))


def _missing(dataset: str, stage: str, table: str, cols: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{dataset}' AS dataset, '{stage}' AS stage, '{name}' AS column_name, "
        f"CAST(SUM(CASE WHEN {expr} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing "
        f"FROM {table}" for name, expr in cols)


_MOVIES_BEFORE = ("(SELECT coalesce(rating_a, rating_b) AS rating, * EXCLUDE (rating_a, rating_b) "
                  "FROM movies_raw)")

_DESCRIBE = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(COUNT({c}) AS DOUBLE) AS count, "
    f"round(AVG(CAST({c} AS DOUBLE)), 6) AS mean, "
    f"round(STDDEV_SAMP(CAST({c} AS DOUBLE)), 6) AS std, "
    f"CAST(MIN({c}) AS DOUBLE) AS min, quantile_cont(CAST({c} AS DOUBLE), 0.25) AS p25, "
    f"quantile_cont(CAST({c} AS DOUBLE), 0.5) AS p50, "
    f"quantile_cont(CAST({c} AS DOUBLE), 0.75) AS p75, CAST(MAX({c}) AS DOUBLE) AS max "
    f"FROM txns" for c in TXN_NUMERIC)

ORACLE = {
    "countries_clean": "SELECT * FROM countries_clean",
    "population_clean": "SELECT * FROM population_clean",
    "movies_clean": "SELECT * FROM movies_clean",
    "quality_before_after": " UNION ALL ".join([
        _summary("countries", "countries_raw", "countries_clean",
                 ['"Country "', '"Region"'], ["country", "region"]),
        _summary("population", "population_raw", "population_clean",
                 ['"Country"', '"Continent"', '"2022 Population"', '"Density (per km²)"',
                  '"Rank"'],
                 ["country", "continent", '"2022_population"', "density_per_km2", "rank"]),
        _summary("movies", _MOVIES_BEFORE + " mb", "movies_clean",
                 ["rating", '"Movie"', '"Genre"', '"Popcorn Score"', "popcornscore",
                  '"Tomato Score"', '"Gross"'],
                 ["gross", "genre", "movie", "popcorn_score", "rating", "tomato_score"])]),
    "quality_missing": " UNION ALL ".join([
        _missing("countries", "before", "countries_raw",
                 [("country", '"Country "'), ("region", '"Region"')]),
        _missing("countries", "after", "countries_clean",
                 [("country", "country"), ("region", "region")]),
        _missing("population", "before", "population_raw",
                 [("country", '"Country"'), ("continent", '"Continent"'),
                  ("2022_population", '"2022 Population"'),
                  ("density_per_km2", '"Density (per km²)"'), ("rank", '"Rank"')]),
        _missing("population", "after", "population_clean",
                 [(c, f'"{c}"') for c in ("country", "continent", "2022_population",
                                          "density_per_km2", "rank")]),
        _missing("movies", "before", "movies_raw",
                 [("gross", '"Gross"'), ("genre", '"Genre"'), ("movie", '"Movie"'),
                  ("popcorn_score", '"Popcorn Score"'), ("popcornscore", "popcornscore"),
                  ("rating", "coalesce(rating_a, rating_b)"),
                  ("tomato_score", '"Tomato Score"')]),
        _missing("movies", "after", "movies_clean",
                 [(c, c) for c in ("gross", "genre", "movie", "popcorn_score", "rating",
                                   "tomato_score")])]),
    "countries_sub_saharan": "SELECT * FROM countries_clean WHERE coalesce(contains("
                             f"lower(region), '{REGION_PATTERN.lower()}'), false)",
    "population_large": 'SELECT country, continent, "2022_population", density_per_km2 FROM '
                        f'population_clean WHERE "2022_population" > {LARGE_POPULATION} '
                        'ORDER BY "2022_population" DESC NULLS LAST',
    "movies_high_tomato": "SELECT movie, rating, tomato_score, popcorn_score FROM movies_clean "
                          f"WHERE tomato_score >= {HIGH_TOMATO} ORDER BY tomato_score DESC "
                          "NULLS LAST, movie ASC LIMIT 10",
    "countries_by_region": "SELECT region, COUNT(*) AS number_of_countries FROM countries_clean "
                           "WHERE region IS NOT NULL GROUP BY region "
                           "ORDER BY number_of_countries DESC",
    "population_by_continent": 'SELECT continent, SUM("2022_population") AS '
                               'total_2022_population, round(AVG("2022_population"), 6) AS '
                               "average_2022_population, round(AVG(density_per_km2), 6) AS "
                               "average_density, "
                               "COUNT(country) AS number_of_countries FROM population_clean "
                               "WHERE continent IS NOT NULL GROUP BY continent",
    "movies_by_rating": "SELECT rating, COUNT(movie) AS number_of_movies, round(AVG(tomato_score), 6) AS "
                        "average_tomato_score, round(AVG(popcorn_score), 6) AS "
                        "average_popcorn_score, round(AVG(gross), 6) AS average_gross FROM movies_clean WHERE rating IS NOT NULL "
                        "GROUP BY rating",
    "eda_countries": "SELECT COUNT(DISTINCT country) AS total_countries, COUNT(DISTINCT region) "
                     "AS total_regions FROM countries_clean",
    "eda_population": 'SELECT COUNT(DISTINCT country) AS total_countries, SUM("2022_population") '
                      'AS total_2022_population, format(\'{:,.0f}\', SUM("2022_population")) AS '
                      'total_2022_population_text, arg_min(country, ("2022_population" * -1, '
                      'country)) AS most_populated_country FROM population_clean',
    "eda_movies": "SELECT COUNT(DISTINCT movie) AS total_movies, round_even(AVG(tomato_score), 2) "
                  "AS average_tomato_score, round_even(AVG(popcorn_score), 2) AS "
                  "average_popcorn_score FROM movies_clean",
    "txn_head": "SELECT * FROM txns ORDER BY ts, event_id LIMIT 5",
    "txn_describe": _DESCRIBE,
    "txn_totals": "SELECT SUM(amount) AS total_amount, round(AVG(CAST(amount AS DOUBLE)), 6) AS "
                  "average_amount, MAX(amount) AS highest_amount, MIN(amount) AS lowest_amount "
                  "FROM txns",
}

RECIPES = ["countries_raw", "population_raw", "movies_raw", "ledger_txns"]


def oracle_sql(key: str) -> str:
    return fixtures.duckdb_with(RECIPES, ORACLE[key], extra=ORACLE_CTES)


def queries():
    return {key: (fn, oracle_sql(key)) for key, fn in REPORTS.items()}

"""Input tables of the reference scripts, derived from the driver's tables.

The reference ships no data. Each input below is a fixed SQL recipe over the
driver's parquet tables; the same text runs in Spark (tables passed as
DataFrame parameters, no global views) and in DuckDB (pasted as a CTE in the
oracle SQL), so both engines see identical inputs.

Placeholders ``{orders}`` etc. name base tables. Back-ticks quote odd column
names; ``duckdb_sql`` turns them into double quotes.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from .tables import table

# Fixed date that stands in for GETDATE() in the HR script.
HR_AS_OF = "2000-06-01 12:00:00"

# Opening balance of every ledger account on the test data.
LEDGER_OPENING_BALANCE = "50.00"

RAW_HR = """
SELECT CAST(o_orderkey AS string) AS id,
       c_name AS first_name,
       concat('L', CAST(o_orderkey % 500 AS string)) AS last_name,
       CASE WHEN o_orderkey % 97 = 0 THEN 'not-a-date'
            WHEN o_orderkey % 89 = 0 THEN NULL
            ELSE concat(CASE WHEN o_orderkey % 5 = 0 THEN '  ' ELSE '' END,
                        CAST(make_date(CAST(1940 + o_orderkey % 45 AS int), CAST(1 + o_orderkey % 12 AS int), CAST(1 + o_orderkey % 28 AS int)) AS string),
                        ' ') END AS birthdate,
       CASE WHEN c_custkey % 7 = 0 THEN 'Non-Conforming' WHEN c_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
       o_orderpriority AS race,
       c_mktsegment AS department,
       concat(c_mktsegment, '/', n_name) AS jobtitle,
       CASE WHEN o_orderstatus = 'F' THEN 'Remote' ELSE 'Headquarters' END AS location,
       CASE WHEN o_orderkey % 101 = 0 THEN NULL
            ELSE CAST(make_date(CAST(year(o_orderdate) - o_orderkey % (CASE WHEN c_mktsegment = 'FURNITURE' THEN 7 ELSE 17 END) AS int),
                                CAST(month(o_orderdate) AS int), CAST(least(day(o_orderdate), 28) AS int)) AS string) END AS hire_date,
       CASE WHEN ls IS NULL THEN NULL
            WHEN (o_orderkey % 10) >= (CASE c_mktsegment WHEN 'BUILDING' THEN 1 WHEN 'AUTOMOBILE' THEN 3 WHEN 'MACHINERY' THEN 2 WHEN 'FURNITURE' THEN 7 ELSE 5 END) THEN ''
            ELSE concat(CAST(ls AS string), ' UTC') END AS termdate,
       concat(n_name, '-', CAST(c_custkey % 4 AS string)) AS location_city,
       n_name AS location_state
FROM {orders}
JOIN {customer} ON o_custkey = c_custkey
JOIN {nation} ON c_nationkey = n_nationkey
LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS ls FROM {lineitem} GROUP BY l_orderkey) x ON l_orderkey = o_orderkey
"""

FLAT_RETAIL = """
SELECT c.c_custkey AS CustomerID, c.c_name AS CustomerName,
       concat('+', CAST(1000000 + c.c_custkey AS string)) AS Phone,
       concat(CAST(c.c_custkey % 999 AS string), ' Main St') AS Address,
       n.n_name AS City,
       CASE c.c_nationkey % 5 WHEN 0 THEN 'WA' WHEN 1 THEN 'OR' WHEN 2 THEN 'CA' WHEN 3 THEN 'NY' ELSE 'TX' END AS State,
       CAST(10000 + c.c_custkey AS string) AS Zip, r.r_name AS Country, CAST(NULL AS string) AS Notes,
       p.p_partkey AS CookieID, p.p_name AS CookieName,
       CAST(p.p_retailprice AS decimal(10,2)) AS RevenuePerCookie,
       CAST(CAST(p.p_retailprice AS decimal(10,2)) - CAST(p.p_size AS decimal(10,2)) AS decimal(10,2)) AS CostPerCookie,
       o.o_orderkey AS OrderID, CAST(o.o_orderdate AS date) AS OrderDate,
       CAST(o.o_totalprice AS decimal(10,2)) AS OrderTotal, CAST(l.l_quantity AS int) AS Quantity
FROM {lineitem} l
JOIN {orders} o ON l.l_orderkey = o.o_orderkey
JOIN {customer} c ON o.o_custkey = c.c_custkey
JOIN {part} p ON l.l_partkey = p.p_partkey
JOIN {nation} n ON c.c_nationkey = n.n_nationkey
JOIN {region} r ON n.n_regionkey = r.r_regionkey
"""

# Orders in which Spark makes the flat file's joins, by the table joined last: inner joins on the same keys,
# so the rows are the recipe's. A reader that takes a few columns names the table that most of them come
# from; what travels before the last join is then keys.
_FLAT_CUSTOMER = "{customer} c JOIN {nation} n ON c.c_nationkey = n.n_nationkey JOIN {region} r ON n.n_regionkey = r.r_regionkey"
_FLAT_ORDER = f"({{orders}} o JOIN ({_FLAT_CUSTOMER}) ON o.o_custkey = c.c_custkey)"
_FLAT_LINE = "({lineitem} l JOIN {part} p ON l.l_partkey = p.p_partkey)"
FLAT_JOINS = {
    "customer": f"{_FLAT_LINE} JOIN {{orders}} o ON l.l_orderkey = o.o_orderkey JOIN ({_FLAT_CUSTOMER}) ON o.o_custkey = c.c_custkey",
    "part": f"{{lineitem}} l JOIN {_FLAT_ORDER} ON l.l_orderkey = o.o_orderkey JOIN {{part}} p ON l.l_partkey = p.p_partkey",
    "orders": f"{_FLAT_LINE} JOIN {_FLAT_ORDER} ON l.l_orderkey = o.o_orderkey",
}

# The second copy of every fourth nation (one trailing space instead of two)
# becomes an exact duplicate only after trimming.
_COUNTRY_REGION = """CASE WHEN n_nationkey % 6 = 0 THEN NULL
            ELSE concat(CASE WHEN r_name = 'AFRICA' THEN 'SUB-SAHARAN AFRICA' ELSE r_name END, '   ') END"""

COUNTRIES_RAW = f"""
SELECT concat(' ', n_name, '  ') AS `Country `, {_COUNTRY_REGION} AS `Region`
FROM {{nation}} JOIN {{region}} ON n_regionkey = r_regionkey
UNION ALL
SELECT concat(' ', n_name, ' ') AS `Country `, {_COUNTRY_REGION} AS `Region`
FROM {{nation}} JOIN {{region}} ON n_regionkey = r_regionkey
WHERE n_nationkey % 4 = 0
"""

# Every 20th customer appears twice (exact duplicates).
_POPULATION_ROW = """
SELECT concat(c_name, ' ') AS `Country`, r_name AS `Continent`,
       CASE WHEN c_custkey % 13 = 0 THEN 'N.A.' WHEN c_custkey % 17 = 0 THEN NULL
            WHEN c_custkey % 29 = 0 THEN '5d' WHEN c_custkey % 37 = 0 THEN '0x1p3' WHEN c_custkey % 43 = 0 THEN '1.5e3'
            ELSE CAST(c_custkey * 150000 AS string) END AS `2022 Population`,
       CASE WHEN c_custkey % 11 = 0 THEN '' ELSE CAST(CAST(c_acctbal AS decimal(12,2)) AS string) END AS `Density (per km²)`,
       CAST(c_custkey + 1 AS string) AS `Rank`
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey"""

POPULATION_RAW = _POPULATION_ROW + "\nUNION ALL" + _POPULATION_ROW + "\nWHERE c_custkey % 20 = 0\n"

# `rating_a` / `rating_b` stand for the JSON keys "Rating" and "rating".
MOVIES_RAW = """
SELECT concat('Movie ', CAST(p_partkey AS string)) AS `Movie`,
       CASE WHEN p_partkey % 3 = 0 THEN NULL WHEN p_partkey % 19 = 0 THEN 'unkown' ELSE p_brand END AS `rating_a`,
       CASE WHEN p_partkey % 3 = 0 AND p_partkey % 5 <> 0 THEN concat(' ', p_brand) ELSE NULL END AS `rating_b`,
       CASE WHEN p_partkey % 23 = 0 THEN 'unknown' WHEN p_partkey % 29 = 0 THEN '-1.0' WHEN p_partkey % 31 = 0 THEN 'None' ELSE p_type END AS `Genre`,
       CASE WHEN p_partkey % 7 = 0 THEN '-1' WHEN p_partkey % 11 = 0 THEN '-1.0' WHEN p_partkey % 13 = 0 THEN '7f' WHEN p_partkey % 2 = 0 THEN NULL ELSE CAST(p_size * 2 AS string) END AS `Popcorn Score`,
       CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size + 40 AS string) ELSE NULL END AS `popcornscore`,
       CASE WHEN p_partkey % 10 = 0 THEN '-1' ELSE CAST(50 + p_size AS string) END AS `Tomato Score`,
       CASE WHEN p_partkey % 9 = 0 THEN 'unknown' ELSE concat('$', CAST(p_partkey % 900 AS string), ',000') END AS `Gross`
FROM {part}
"""

LEDGER_TXNS = """
SELECT user_id AS account_id, ts, event_id,
       CASE event_type WHEN 'signup' THEN 'deposit' WHEN 'purchase' THEN 'transfer' WHEN 'click' THEN 'airtime' ELSE 'enquiry' END AS txn_type,
       CAST(CASE WHEN event_id % 41 = 0 THEN 0 WHEN event_type IN ('purchase','click') THEN value * 3 ELSE value END AS decimal(12,2)) AS amount,
       CAST(event_id % 6 AS int) AS network_choice
FROM {events}
"""

# Employee tables of the week 13-15 scripts. The reference has 9 inline
# employees, all with a salary row, adds 3 more in week 14 (no salary rows)
# and keeps a warehouse table that shares a row with them. On the test data
# one customer is one employee: customers with a non-negative account balance
# are the first hires (each with a salary row), customers with a negative
# balance are added in week 14, and suppliers plus the added employees below
# -500 form the warehouse table (so UNION has duplicates to remove).
_EMP_COLUMNS = """
SELECT CAST(c_custkey AS bigint) AS EmployeeID,
       c_name AS FirstName,
       concat('L', CAST(c_custkey % 50 AS string)) AS LastName,
       CASE WHEN c_custkey % 23 = 0 THEN CAST(NULL AS int) ELSE CAST(22 + c_custkey % 41 AS int) END AS Age,
       CASE WHEN c_custkey % 31 = 0 THEN CAST(NULL AS string) WHEN c_nationkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS Gender
FROM {customer}"""

EMP_DEMOGRAPHICS = _EMP_COLUMNS + "\nWHERE c_acctbal >= 0\n"

EMP_DEMOGRAPHICS_ADDED = _EMP_COLUMNS + "\nWHERE c_acctbal < 0\n"

# The week-14 UPDATE on the test data.
EMP_UPDATE_FIRST, EMP_UPDATE_LAST, EMP_UPDATE_AGE = "Customer#000000010", "L10", 31

EMP_SALARY = """
SELECT CAST(c_custkey AS bigint) AS EmployeeID,
       c_mktsegment AS JobTitle,
       CAST(30000 + (c_custkey * 37 % 71) * 500 AS int) AS Salary
FROM {customer}
WHERE c_acctbal >= 0
UNION ALL
SELECT CAST(-1000000000000 - s_suppkey AS bigint) AS EmployeeID,
       'CONTRACT' AS JobTitle,
       CAST(20000 + s_suppkey % 90 * 100 AS int) AS Salary
FROM {supplier}
WHERE s_suppkey % 5 = 0
"""

EMP_WAREHOUSE = """
SELECT CAST(-s_suppkey AS bigint) AS EmployeeID,
       s_name AS FirstName,
       concat('W', CAST(s_suppkey % 50 AS string)) AS LastName,
       CASE WHEN s_suppkey % 9 = 0 THEN CAST(NULL AS int) ELSE CAST(20 + s_suppkey % 45 AS int) END AS Age,
       CASE WHEN s_nationkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS Gender
FROM {supplier}
UNION ALL
""" + _EMP_COLUMNS + "\nWHERE c_acctbal < -500\n"

RECIPES = {
    "hr_data": RAW_HR,
    "flat_file": FLAT_RETAIL,
    "countries_raw": COUNTRIES_RAW,
    "population_raw": POPULATION_RAW,
    "movies_raw": MOVIES_RAW,
    "ledger_txns": LEDGER_TXNS,
    "emp_demographics": EMP_DEMOGRAPHICS,
    "emp_demographics_added": EMP_DEMOGRAPHICS_ADDED,
    "emp_salary": EMP_SALARY,
    "emp_warehouse": EMP_WAREHOUSE,
}

_PLACEHOLDER = re.compile(r"\{(\w+)\}")


def recipe_tables(name: str) -> list[str]:
    return sorted(set(_PLACEHOLDER.findall(RECIPES[name])))


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Spark DataFrame of one recipe, built from the parquet tables it names."""
    text = RECIPES[name]
    frames = {t: table(spark, sf_dir, t) for t in recipe_tables(name)}
    return spark.sql(text, **frames)


def flat_file(spark: SparkSession, sf_dir: str, last: str) -> DataFrame:
    """The flat file's recipe, its joins made in the order ``FLAT_JOINS[last]``."""
    columns = FLAT_RETAIL.partition("\nFROM ")[0]
    frames = {t: table(spark, sf_dir, t) for t in recipe_tables("flat_file")}
    return spark.sql(f"{columns}\nFROM {FLAT_JOINS[last]}", **frames)


def duckdb_sql(name: str) -> str:
    """The same recipe for DuckDB, over the driver's pre-registered views."""
    text = RECIPES[name]
    text = _PLACEHOLDER.sub(lambda m: m.group(1), text)
    return text.replace("`", '"').strip()


def duckdb_with(names: list[str] | tuple[str, ...], body: str, extra: str = "",
                recursive: bool = False) -> str:
    """``WITH name AS (recipe), ..., extra CTEs body`` for the oracle."""
    ctes = ",\n".join(f"{n} AS (\n{duckdb_sql(n)}\n)" for n in names)
    if extra:
        ctes = f"{ctes},\n{extra.strip()}"
    return f"WITH {'RECURSIVE ' if recursive else ''}{ctes}\n{body}"

"""The HR analytics report catalogue (workforce, demographics, tenure, attrition).

Nearly every report of the HR script is "filter -> group -> counts / rates /
averages -> maybe HAVING, rank or tier -> order". ``Report`` names those
parts once; ``spark_report`` turns it into a DataFrame plan over the cached
clean table and ``sql_report`` into the independent DuckDB oracle query.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import metrics as M
from ..operators import hr as hr_ops
from ..operators.rank import global_rank
from ..sources import fixtures
from . import oracle as O
from .cache import cached

AS_OF = fixtures.HR_AS_OF



def ACTIVE():
    return F.col("employee_status") == "Active"


def TERMINATED():
    return F.col("employee_status") == "Terminated"


S_ACTIVE = "SUM(CASE WHEN employee_status = 'Active' THEN 1 ELSE 0 END)"
S_TERM = "SUM(CASE WHEN employee_status = 'Terminated' THEN 1 ELSE 0 END)"

# name -> (Spark aggregate, DuckDB aggregate)
METRICS = {
    "count": (lambda: F.count(F.lit(1)), "CAST(COUNT(*) AS BIGINT)"),
    "active": (lambda: M.count_if(ACTIVE()), f"CAST({S_ACTIVE} AS BIGINT)"),
    "terminated": (lambda: M.count_if(TERMINATED()), f"CAST({S_TERM} AS BIGINT)"),
    "attrition": (lambda: M.pct(M.count_if(TERMINATED()), F.count(F.lit(1))),
                  O.pct(S_TERM, "COUNT(*)")),
    "retention": (lambda: M.pct(M.count_if(ACTIVE()), F.count(F.lit(1))),
                  O.pct(S_ACTIVE, "COUNT(*)")),
    "avg_tenure": (lambda: M.avg_dec("tenure_years"), O.avg2("tenure_years")),
    "avg_age": (lambda: M.avg_dec("age"), O.avg2("age")),
    "min_tenure": (lambda: F.min("tenure_years"), "MIN(tenure_years)"),
    "max_tenure": (lambda: F.max("tenure_years"), "MAX(tenure_years)"),
    "genders": (lambda: F.countDistinct("gender"), "CAST(COUNT(DISTINCT gender) AS BIGINT)"),
    "races": (lambda: F.countDistinct("race"), "CAST(COUNT(DISTINCT race) AS BIGINT)"),
}
for _c in ("birthdate", "hire_date", "termdate", "age", "tenure_years"):
    METRICS[f"missing_{_c}"] = (
        (lambda c=_c: M.count_if(F.col(c).isNull())),
        f"CAST(SUM(CASE WHEN {_c} IS NULL THEN 1 ELSE 0 END) AS BIGINT)")

# Default output names of the metrics.
NAMES = {
    "count": "total_employees", "active": "active_employees",
    "terminated": "terminated_employees", "attrition": "attrition_rate_percentage",
    "retention": "retention_rate_percentage", "avg_tenure": "average_tenure_years",
    "avg_age": "average_age", "min_tenure": "minimum_tenure_years",
    "max_tenure": "maximum_tenure_years", "genders": "gender_groups_represented",
    "races": "race_groups_represented",
}

# computed group keys: name -> (Spark column, DuckDB expression)
KEYS = {
    "age_group": (lambda: M.band("age", M.AGE_BANDS), O.band("age", M.AGE_BANDS)),
    "tenure_group": (lambda: M.band("tenure_years", M.TENURE_BANDS),
                     O.band("tenure_years", M.TENURE_BANDS)),
    "termination_year": (lambda: F.year("termdate"), "CAST(year(termdate) AS INTEGER)"),
    "termination_month": (lambda: F.month("termdate"), "CAST(month(termdate) AS INTEGER)"),
}

FILTERS = {
    "active": (ACTIVE, "employee_status = 'Active'"),
    "terminated": (TERMINATED, "employee_status = 'Terminated'"),
    "has_age": (lambda: F.col("age").isNotNull(), "age IS NOT NULL"),
    "has_tenure": (lambda: F.col("tenure_years").isNotNull(), "tenure_years IS NOT NULL"),
    "exited": (lambda: TERMINATED() & F.col("termdate").isNotNull(),
               "employee_status = 'Terminated' AND termdate IS NOT NULL"),
}

# Tiers and texts of the HR script's classifications.
RISK_TIERS = ((20, "High Risk"), (10, "Medium Risk"))
RISK_OTHER = "Low Risk"
RETENTION_TIERS = ((90, "Strong Retention"), (80, "Moderate Retention"))
RETENTION_OTHER = "Needs Attention"
CONCERN_TIERS = ((20, "High Retention Concern"), (10, "Medium Retention Concern"))
CONCERN_OTHER = "Low Retention Concern"
REC_PRIORITY = "Priority Action: Investigate early exits and improve retention programs"
REC_ACTION = "Action Needed: Review workload, engagement, and career growth opportunities"
REC_MONITOR = "Monitor: Strengthen employee engagement and manager support"
REC_MAINTAIN = "Maintain: Continue current retention practices"


@dataclass(frozen=True)
class Report:
    keys: tuple = ()
    metrics: tuple = ()          # metric names, or (output name, metric name)
    where: str | None = None
    min_count: int | None = None  # HAVING COUNT(*) >= n
    post: tuple = ()             # steps on the aggregate, see _post_*
    order: tuple = ()            # ((column, descending), ...)
    limit: int | None = None


def _metric(m):
    return (NAMES.get(m, m), m) if isinstance(m, str) else m


# ---------------------------------------------------------------- Spark side

def _post_spark(df: DataFrame, step) -> DataFrame:
    kind = step[0]
    if kind == "share":
        return df.withColumn(step[1], M.share_of_total("total_employees"))
    if kind == "rank":
        # The input is the aggregate (one row per group), so one task is fine.
        w = Window.orderBy(*[F.col(c).desc() if d else F.col(c).asc() for c, d in step[2]])
        return df.withColumn(step[1], F.rank().over(w).cast("bigint"))
    if kind == "tier":
        _, out, src, tiers, other = step
        return df.withColumn(out, M.classify(src, tiers, other))
    if kind == "recommend":
        a, t = F.col("attrition_rate_percentage"), F.col("average_tenure_years")
        rec = (F.when((a >= 20) & (t < 5), REC_PRIORITY)
               .when((a >= 20) & (t >= 5), REC_ACTION)
               .when(a.between(Decimal("10"), Decimal("19.99")), REC_MONITOR)
               .otherwise(REC_MAINTAIN))
        return df.withColumn(step[1], rec)
    raise ValueError(kind)


def spark_report(emp: DataFrame, r: Report) -> DataFrame:
    df = emp
    if r.where:
        df = df.filter(FILTERS[r.where][0]())
    keys = [KEYS[k][0]().alias(k) if k in KEYS else F.col(k) for k in r.keys]
    aggs = [METRICS[m][0]().alias(out) for out, m in map(_metric, r.metrics)]
    if r.min_count is not None:
        aggs.append(F.count(F.lit(1)).alias("_having"))
    out = df.groupBy(*keys).agg(*aggs)
    if r.min_count is not None:
        out = out.filter(F.col("_having") >= r.min_count).drop("_having")
    for step in r.post:
        out = _post_spark(out, step)
    if r.order:
        out = out.orderBy(*[F.col(c).desc() if d else F.col(c).asc() for c, d in r.order])
    if r.limit:
        out = out.limit(r.limit)
    return out


# --------------------------------------------------------------- oracle side

def _post_sql(step) -> str:
    kind = step[0]
    if kind == "share":
        return f"{O.pct('total_employees', 'SUM(total_employees) OVER ()')} AS {step[1]}"
    if kind == "rank":
        order = ", ".join(f"{c} DESC NULLS LAST" if d else f"{c} ASC NULLS FIRST"
                          for c, d in step[2])
        return f"CAST(RANK() OVER (ORDER BY {order}) AS BIGINT) AS {step[1]}"
    if kind == "tier":
        _, out, src, tiers, other = step
        whens = " ".join(f"WHEN {src} >= {t} THEN '{lab}'" for t, lab in tiers)
        return f"CASE {whens} ELSE '{other}' END AS {out}"
    if kind == "recommend":
        return ("CASE WHEN attrition_rate_percentage >= 20 AND average_tenure_years < 5 "
                f"THEN '{REC_PRIORITY}' "
                "WHEN attrition_rate_percentage >= 20 AND average_tenure_years >= 5 "
                f"THEN '{REC_ACTION}' "
                "WHEN attrition_rate_percentage BETWEEN 10 AND 19.99 "
                f"THEN '{REC_MONITOR}' ELSE '{REC_MAINTAIN}' END AS {step[1]}")
    raise ValueError(kind)


EMP_SQL = f"""
hr_data_clean AS (
  SELECT id, first_name, last_name, gender, race, department, jobtitle, location,
         location_city, location_state,
         TRY_CAST(trim(birthdate, ' ') AS DATE) AS birthdate,
         TRY_CAST(trim(hire_date, ' ') AS DATE) AS hire_date,
         TRY_CAST(NULLIF(replace(trim(termdate, ' '), ' UTC', ''), '') AS TIMESTAMP) AS termdate
  FROM hr_data
),
emp AS (
  SELECT *,
    CASE WHEN termdate IS NULL THEN 'Active'
         WHEN termdate > TIMESTAMP '{AS_OF}' THEN 'Active'
         ELSE 'Terminated' END AS employee_status,
    CAST(CASE WHEN birthdate IS NULL THEN NULL
              ELSE {O.years_between('birthdate', f"TIMESTAMP '{AS_OF}'")} END AS INTEGER) AS age,
    CAST(CASE WHEN hire_date IS NULL THEN NULL
              WHEN termdate IS NULL OR termdate > TIMESTAMP '{AS_OF}'
                THEN {O.years_between('hire_date', f"TIMESTAMP '{AS_OF}'")}
              ELSE {O.years_between('hire_date', 'termdate')} END AS INTEGER) AS tenure_years
  FROM hr_data_clean
)"""


def with_emp(body: str) -> str:
    """Oracle query over the clean HR table ``emp``."""
    return fixtures.duckdb_with(["hr_data"], body, extra=EMP_SQL)


def sql_report(r: Report) -> str:
    keys = [f"{KEYS[k][1]} AS {k}" if k in KEYS else k for k in r.keys]
    group = [KEYS[k][1] if k in KEYS else k for k in r.keys]
    aggs = [f"{METRICS[m][1]} AS {out}" for out, m in map(_metric, r.metrics)]
    sql = f"SELECT {', '.join(keys + aggs)} FROM emp"
    if r.where:
        sql += f" WHERE {FILTERS[r.where][1]}"
    if group:
        sql += f" GROUP BY {', '.join(group)}"
    if r.min_count is not None:
        sql += f" HAVING COUNT(*) >= {r.min_count}"
    if r.post:
        sql = f"SELECT *, {', '.join(_post_sql(s) for s in r.post)} FROM ({sql}) t"
    sql = f"{sql} {O.order_by(r.order)}"
    if r.limit:
        sql += f" LIMIT {r.limit}"
    return with_emp(sql)


# ------------------------------------------------------------------ catalogue

C, A, T = "count", "active", "terminated"
RATES = (C, A, T, "attrition")
ATTR = (C, T, "attrition")
D = True

REPORTS: dict[str, Report] = {
    "hr_status_counts": Report(("employee_status",), (C,), order=(("total_employees", D),)),
    "hr_missing_values": Report((), (("total_records", C), "missing_birthdate",
                                     "missing_hire_date", "missing_termdate",
                                     "missing_age", "missing_tenure_years")),
    "hr_total": Report((), (C,)),
    "hr_status_share": Report(("employee_status",), (C,), post=(("share", "percentage_share"),),
                              order=(("percentage_share", D),)),
    "hr_attrition_rate": Report((), ATTR),
    "hr_retention_rate": Report((), (C, A, "retention")),
    "hr_exec_summary": Report((), (C, A, T, "retention", "attrition")),
    "hr_location_share": Report(("location",), (C,), post=(("share", "percentage_share"),),
                                order=(("total_employees", D),)),
    "hr_state_share": Report(("location_state",), (C,), post=(("share", "percentage_share"),),
                             order=(("total_employees", D),)),
    "hr_city_counts": Report(("location_city", "location_state"), (C,),
                             order=(("total_employees", D),)),
    "hr_gender_share": Report(("gender",), (C,), post=(("share", "percentage_share"),),
                              order=(("total_employees", D),)),
    "hr_race_share": Report(("race",), (C,), post=(("share", "percentage_share"),),
                            order=(("total_employees", D),)),
    "hr_age_counts": Report(("age",), (C,), where="has_age", order=(("age", False),)),
    "hr_age_group_share": Report(("age_group",), (C,), post=(("share", "percentage_share"),),
                                 order=(("total_employees", D),)),
    "hr_dept_gender": Report(("department", "gender"), (C,),
                             order=(("department", False), ("total_employees", D))),
    "hr_dept_race": Report(("department", "race"), (C,),
                           order=(("department", False), ("total_employees", D))),
    "hr_dept_demographics": Report(("department",), (C, "genders", "races", "avg_age"),
                                   where="has_age", order=(("total_employees", D),)),
    "hr_diversity_rank": Report(("department",), (C, "races", "genders"),
                                post=(("rank", "diversity_rank",
                                       (("race_groups_represented", D),
                                        ("gender_groups_represented", D))),),
                                order=(("diversity_rank", False), ("total_employees", D))),
    "hr_age_group_status": Report(("age_group", "employee_status"), (C,),
                                  order=(("age_group", False), ("employee_status", False))),
    "hr_attrition_gender": Report(("gender",), ATTR, order=(("attrition_rate_percentage", D),)),
    "hr_attrition_race": Report(("race",), ATTR, order=(("attrition_rate_percentage", D),)),
    "hr_dept_share": Report(("department",), (C,), post=(("share", "percentage_share"),),
                            order=(("total_employees", D),)),
    "hr_jobtitle_counts": Report(("jobtitle",), (C,), order=(("total_employees", D),)),
    "hr_dept_active": Report(("department",), (("active_employees", C),), where="active",
                             order=(("active_employees", D),)),
    "hr_dept_terminated": Report(("department",), (("terminated_employees", C),),
                                 where="terminated", order=(("terminated_employees", D),)),
    "hr_dept_attrition": Report(("department",), RATES,
                                order=(("attrition_rate_percentage", D),)),
    "hr_job_attrition": Report(("jobtitle",), RATES, min_count=10,
                               order=(("attrition_rate_percentage", D),)),
    "hr_dept_headcount_rank": Report(("department",), (C,),
                                     post=(("rank", "department_headcount_rank",
                                            (("total_employees", D),)),),
                                     order=(("department_headcount_rank", False),)),
    "hr_dept_attrition_rank": Report(("department",), ATTR,
                                     post=(("rank", "attrition_rank",
                                            (("attrition_rate_percentage", D),)),),
                                     order=(("attrition_rank", False),)),
    "hr_top10_jobs": Report(("jobtitle",), (C,), order=(("total_employees", D),
                                                        ("jobtitle", False)), limit=10),
    "hr_top10_jobs_terminated": Report(("jobtitle",), (("terminated_employees", C),),
                                       where="terminated",
                                       order=(("terminated_employees", D), ("jobtitle", False)),
                                       limit=10),
    "hr_dept_location": Report(("department", "location"), (C,),
                               order=(("department", False), ("total_employees", D))),
    "hr_avg_tenure": Report((), ("avg_tenure",), where="has_tenure"),
    "hr_tenure_by_status": Report(("employee_status",), (C, "avg_tenure", "min_tenure",
                                                         "max_tenure"),
                                  where="has_tenure", order=(("average_tenure_years", D),)),
    "hr_tenure_counts": Report(("tenure_years",), (C,), where="has_tenure",
                               order=(("tenure_years", False),)),
    "hr_tenure_group_share": Report(("tenure_group",), (C,),
                                    post=(("share", "percentage_share"),),
                                    order=(("total_employees", D),)),
    "hr_tenure_group_status": Report(("tenure_group", "employee_status"), (C,),
                                     order=(("tenure_group", False),
                                            ("employee_status", False))),
    "hr_tenure_group_attrition": Report(("tenure_group",), ATTR,
                                        order=(("attrition_rate_percentage", D),)),
    "hr_dept_avg_tenure": Report(("department",), (C, "avg_tenure"), where="has_tenure",
                                 order=(("average_tenure_years", D),)),
    "hr_job_avg_tenure": Report(("jobtitle",), (C, "avg_tenure"), where="has_tenure",
                                min_count=10, order=(("average_tenure_years", D),)),
    "hr_dept_retention": Report(("department",), (C, A, T, "retention", "avg_tenure"),
                                where="has_tenure",
                                order=(("retention_rate_percentage", D),
                                       ("average_tenure_years", D))),
    "hr_dept_retention_rank": Report(("department",), (C, A, T, "retention"),
                                     post=(("rank", "retention_rank",
                                            (("retention_rate_percentage", D),)),),
                                     order=(("retention_rank", False),)),
    "hr_overall_attrition": Report((), (C, A, T, "attrition", "retention")),
    "hr_attrition_location": Report(("location",), RATES,
                                    order=(("attrition_rate_percentage", D),)),
    "hr_attrition_state": Report(("location_state",), RATES,
                                 order=(("attrition_rate_percentage", D),)),
    "hr_attrition_age_group": Report(("age_group",), RATES,
                                     order=(("attrition_rate_percentage", D),)),
    "hr_attrition_tenure_group": Report(("tenure_group",), RATES,
                                        order=(("attrition_rate_percentage", D),)),
    "hr_exits_by_year": Report(("termination_year",), (("terminated_employees", C),),
                               where="exited", order=(("termination_year", False),)),
    "hr_exits_by_month": Report(("termination_year", "termination_month"),
                                (("terminated_employees", C),), where="exited",
                                order=(("termination_year", False),
                                       ("termination_month", False))),
    "hr_job_attrition_rank": Report(("jobtitle",), ATTR, min_count=10,
                                    post=(("rank", "attrition_rank",
                                           (("attrition_rate_percentage", D),)),),
                                    order=(("attrition_rank", False), ("total_employees", D))),
    "hr_risk_segments": Report(("department", "location", "tenure_group"), ATTR,
                               min_count=20, order=(("attrition_rate_percentage", D),)),
    "hr_kpi": Report((), (C, A, T, "attrition", "retention",
                          ("average_employee_age", "avg_age"), "avg_tenure")),
    "hr_top5_headcount": Report(("department",), (C,),
                                order=(("total_employees", D), ("department", False)), limit=5),
    "hr_top5_attrition": Report(("department",), ATTR,
                                order=(("attrition_rate_percentage", D), ("department", False)),
                                limit=5),
    "hr_top5_retention": Report(("department",), (C, A, "retention"),
                                order=(("retention_rate_percentage", D), ("department", False)),
                                limit=5),
    "hr_risk_level": Report(("department",), ATTR,
                            post=(("tier", "attrition_risk_level", "attrition_rate_percentage",
                                   RISK_TIERS, RISK_OTHER),),
                            order=(("attrition_rate_percentage", D),)),
    "hr_retention_strength": Report(("department",), (C, A, "retention"),
                                    post=(("tier", "retention_strength",
                                           "retention_rate_percentage",
                                           RETENTION_TIERS, RETENTION_OTHER),),
                                    order=(("retention_rate_percentage", D),)),
    "hr_tenure_concern": Report(("tenure_group",), ATTR,
                                post=(("tier", "retention_concern_level",
                                       "attrition_rate_percentage",
                                       CONCERN_TIERS, CONCERN_OTHER),),
                                order=(("attrition_rate_percentage", D),)),
    "hr_recommendation": Report(("department",), (C, A, T, "attrition", "avg_tenure"),
                                post=(("recommend", "hr_recommendation"),),
                                order=(("attrition_rate_percentage", D),)),
}


# ------------------------------------------------------------- tables, rows

def raw_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.fixture(spark, sf_dir, "hr_data")


def clean_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hr_ops.clean(raw_table(spark, sf_dir))


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """hr_data_clean with derived columns, built once per session and input.

    The reference stores it as a table and reads it in every report; here it
    is cached (memory, spilling to disk) and rebuilt from lineage if lost.
    """
    return cached(spark, ("hr_emp", sf_dir),
                  lambda: hr_ops.derive(clean_table(spark, sf_dir), AS_OF))


CLEAN_COLS = ("id", "first_name", "last_name", "gender", "race", "department", "jobtitle",
              "location", "location_city", "location_state", "birthdate", "hire_date",
              "termdate")
LONGEST_COLS = ("id", "first_name", "last_name", "department", "jobtitle", "hire_date",
                "termdate", "employee_status", "tenure_years")
RANK_COLS = ("id", "first_name", "last_name", "department", "jobtitle", "employee_status",
             "tenure_years")
PREVIEW_DERIVED = ("id", "first_name", "last_name", "birthdate", "age", "hire_date",
                   "termdate", "tenure_years", "employee_status", "department", "jobtitle",
                   "location", "location_city", "location_state")


def _cols(cols) -> str:
    return ", ".join(cols)


def row_queries():
    """Row-level and preview queries: key -> (Spark builder, oracle SQL or None)."""
    emp_all = _cols(CLEAN_COLS + ("employee_status", "age", "tenure_years"))
    return {
        # TOP n without ORDER BY returns any n rows; taking the first n by id
        # (a top-k, not a sort) makes the preview checkable.
        "hr_preview_raw": (lambda s, d: raw_table(s, d).orderBy("id").limit(10),
                           fixtures.duckdb_with(["hr_data"],
                                                "SELECT * FROM hr_data ORDER BY id LIMIT 10")),
        "hr_raw_count": (
            lambda s, d: raw_table(s, d).agg(F.count(F.lit(1)).alias("row_count")),
            fixtures.duckdb_with(["hr_data"],
                                 "SELECT CAST(COUNT(*) AS BIGINT) AS row_count FROM hr_data")),
        "hr_clean": (lambda s, d: clean_table(s, d),
                     with_emp(f"SELECT {_cols(CLEAN_COLS)} FROM hr_data_clean")),
        "hr_preview_clean": (
            lambda s, d: clean_table(s, d).select("id", "first_name", "last_name",
                                                  "birthdate", "hire_date", "termdate")
            .orderBy("id").limit(20),
            with_emp("SELECT id, first_name, last_name, birthdate, hire_date, termdate "
                     "FROM hr_data_clean ORDER BY id LIMIT 20")),
        "hr_clean_count": (
            lambda s, d: clean_table(s, d).agg(F.count(F.lit(1)).alias("total_records")),
            with_emp("SELECT CAST(COUNT(*) AS BIGINT) AS total_records FROM hr_data_clean")),
        "hr_status": (lambda s, d: employees(s, d).select("id", "termdate", "employee_status"),
                      with_emp("SELECT id, termdate, employee_status FROM emp")),
        "hr_age": (lambda s, d: employees(s, d).select("id", "birthdate", "age"),
                   with_emp("SELECT id, birthdate, age FROM emp")),
        "hr_tenure": (lambda s, d: employees(s, d).select("id", "hire_date", "termdate",
                                                          "employee_status", "tenure_years"),
                      with_emp("SELECT id, hire_date, termdate, employee_status, tenure_years "
                               "FROM emp")),
        "hr_preview_derived": (
            lambda s, d: employees(s, d).select(*PREVIEW_DERIVED).orderBy("id").limit(20),
            with_emp(f"SELECT {_cols(PREVIEW_DERIVED)} FROM emp ORDER BY id LIMIT 20")),
        "hr_bad_rows": (lambda s, d: hr_ops.bad_rows(employees(s, d)),
                        with_emp(f"SELECT {emp_all} FROM emp WHERE hire_date IS NULL "
                                 "OR birthdate IS NULL OR age IS NULL OR tenure_years < 0")),
        "hr_longest_serving": (
            lambda s, d: (employees(s, d).filter(F.col("tenure_years").isNotNull())
                          .select(*LONGEST_COLS)
                          .orderBy(F.col("tenure_years").desc(), F.col("hire_date").asc(),
                                   F.col("id").asc())
                          .limit(20)),
            with_emp(f"SELECT {_cols(LONGEST_COLS)} FROM emp WHERE tenure_years IS NOT NULL "
                     "ORDER BY tenure_years DESC NULLS LAST, hire_date ASC NULLS FIRST, "
                     "id ASC LIMIT 20")),
        "hr_tenure_rank": (
            lambda s, d: global_rank(
                employees(s, d).filter(F.col("tenure_years").isNotNull()).select(*RANK_COLS),
                [("tenure_years", True)], "tenure_rank").orderBy("tenure_rank", "id"),
            with_emp(f"SELECT {_cols(RANK_COLS)}, CAST(RANK() OVER (ORDER BY tenure_years "
                     "DESC NULLS LAST) AS BIGINT) AS tenure_rank FROM emp "
                     "WHERE tenure_years IS NOT NULL ORDER BY tenure_rank, id")),
    }


def queries():
    out = {}
    for key, rep in REPORTS.items():
        out[key] = ((lambda r: lambda s, d: spark_report(employees(s, d), r))(rep),
                    sql_report(rep))
    out.update(row_queries())
    return out

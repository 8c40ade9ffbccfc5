"""The employee database scripts of weeks 13-15 (one database, run in order).

Week 13 creates and fills two tables, week 14 appends employees, updates one
and deletes none, week 15 reads the resulting state. ``Company`` holds the
tables; ``state13`` / ``state14`` / ``state15`` are the table contents each
script sees. The same functions run on the reference's inline rows (tests)
and on tables derived from the driver's data (``load``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.metrics import avg_int
from ..operators import relational as R
from ..operators.rank import global_rank
from ..sources import fixtures
from ..sources.fixtures import EMP_UPDATE_AGE, EMP_UPDATE_FIRST, EMP_UPDATE_LAST
from .cache import cached


@dataclass
class Company:
    demographics: DataFrame   # EmployeeDemographics as filled in week 13
    added: DataFrame          # rows inserted in week 14
    salary: DataFrame         # EmployeeSalary
    warehouse: DataFrame      # WareHouseEmployeeDemographics
    update_first: str = EMP_UPDATE_FIRST
    update_last: str = EMP_UPDATE_LAST
    update_age: int = EMP_UPDATE_AGE
    # Keeps a derived table that one statement reads twice.
    keep: Callable[[str, Callable[[], DataFrame]], DataFrame] = lambda name, build: build()

    def state13(self) -> DataFrame:
        return self.demographics

    def state14(self) -> DataFrame:
        return R.append_rows(self.demographics, self.added)

    def state14_updated(self) -> DataFrame:
        cond = (F.col("FirstName") == self.update_first) & (F.col("LastName") == self.update_last)
        return R.update_where(self.state14(), cond, {"Age": F.lit(self.update_age)})

    def state15(self) -> DataFrame:
        return R.delete_where(self.state14_updated(), F.col("EmployeeID").isNull())


def load(spark: SparkSession, sf_dir: str) -> Company:
    return Company(
        demographics=fixtures.fixture(spark, sf_dir, "emp_demographics"),
        added=fixtures.fixture(spark, sf_dir, "emp_demographics_added"),
        salary=fixtures.fixture(spark, sf_dir, "emp_salary"),
        warehouse=fixtures.fixture(spark, sf_dir, "emp_warehouse"),
        keep=lambda name, build: cached(spark, (name, sf_dir), build),
    )


# ------------------------------------------------------------ the statements

def joined(c: Company, demo: DataFrame) -> DataFrame:
    d, s = demo.alias("d"), c.salary.alias("s")
    return d.join(s, F.col("d.EmployeeID") == F.col("s.EmployeeID"), "inner")


def staff(c: Company) -> DataFrame:
    """The CTE of the last state's employees with their salaries, joined once for all its readers."""
    return c.keep("emp_staff", lambda: joined(c, c.state15()).select(
        "d.FirstName", "s.JobTitle", "s.Salary"))


def outer_joined(c: Company, how: str) -> DataFrame:
    """SELECT * of an outer join: the salary side's key is renamed, not dropped."""
    d = c.state14().alias("d")
    s = c.salary.withColumnRenamed("EmployeeID", "SalaryEmployeeID").alias("s")
    return d.join(s, F.col("d.EmployeeID") == F.col("s.SalaryEmployeeID"), how)


def age_category(df: DataFrame) -> DataFrame:
    age = F.col("Age")
    cat = (F.when(age > 30, "Old").when(age.between(27, 30), "Adult").otherwise("Young"))
    return df.select("FirstName", "LastName", "Age", cat.alias("AgeCategory"))


def job_summary(c: Company) -> DataFrame:
    """#TempEmployee: employees, INT average age and salary per job title."""
    summary = (joined(c, c.state15()).groupBy(F.col("s.JobTitle").alias("JobTitle"))
               .agg(F.count(F.lit(1)).alias("EmployeesPerJob"),
                    avg_int("d.Age").alias("AvgAge"),
                    avg_int("s.Salary").alias("AvgSalary")))
    return R.temp_table(summary, "TempEmployee")


STATEMENTS = {
    "emp_all": lambda c: c.state13(),
    "sal_all": lambda c: c.salary,
    "emp_names": lambda c: c.state13().select("FirstName", "LastName", "Age"),
    "emp_over_30": lambda c: c.state13().filter(F.col("Age") > 30),
    "emp_female": lambda c: c.state13().filter(F.col("Gender") == "Female"),
    "sal_over_50k": lambda c: c.salary.filter(F.col("Salary") > 50000),
    "emp_by_age": lambda c: c.state13().orderBy(F.col("Age").asc()),
    "sal_desc": lambda c: c.salary.orderBy(F.col("Salary").desc()),
    "emp_salary_join": lambda c: joined(c, c.state14()).select(
        "d.EmployeeID", "d.FirstName", "d.LastName", "s.JobTitle", "s.Salary"),
    "emp_salary_left": lambda c: outer_joined(c, "left"),
    "emp_salary_right": lambda c: outer_joined(c, "right"),
    "emp_union": lambda c: R.union_distinct(
        c.state14().select("FirstName", "LastName", "Age"),
        c.warehouse.select("FirstName", "LastName", "Age")),
    "emp_age_category": lambda c: age_category(c.state14()),
    "sal_avg": lambda c: c.salary.agg(avg_int("Salary").alias("AverageSalary")),
    "emp_count": lambda c: c.state14().agg(F.count("EmployeeID").alias("TotalEmployees")),
    "sal_avg_by_job": lambda c: c.salary.groupBy("JobTitle").agg(
        avg_int("Salary").alias("AvgSalary")),
    "emp_update": lambda c: c.state14_updated(),
    "emp_delete": lambda c: c.state15(),
    "emp_fk_orphans": lambda c: c.salary.join(c.state15().select("EmployeeID"),
                                              "EmployeeID", "left_anti"),
    "sal_with_avg_scalar": lambda c: R.with_scalar(
        c.salary.select("EmployeeID", "Salary"), c.salary, avg_int("Salary"),
        "AllAvgSalary"),
    "sal_with_avg_window": lambda c: R.with_scalar(
        c.salary.select("EmployeeID"), c.salary, avg_int("Salary"),
        "AllAvgSalary").orderBy("EmployeeID"),
    "sal_semi_over_30": lambda c: R.semi_in(
        c.salary.select("EmployeeID", "JobTitle", "Salary"),
        c.state15().filter(F.col("Age") > 30), "EmployeeID"),
    "sal_rank": lambda c: global_rank(
        c.salary.select("EmployeeID", "JobTitle", "Salary"), [("Salary", True)],
        "SalaryRank"),
    "sal_rank_by_job": lambda c: global_rank(
        c.salary.select("EmployeeID", "JobTitle", "Salary"), [("Salary", True)],
        "RankByJob", partition_by=["JobTitle"]),
    "emp_cte_avg": lambda c: R.with_scalar(
        staff(c), staff(c), avg_int("Salary"), "AvgSalary"),
    "job_summary_temp": job_summary,
    "emp_top3_salary": lambda c: global_rank(
        staff(c), [("Salary", True)], "SalaryRank").filter(F.col("SalaryRank") <= 3),
}


# --------------------------------------------------------------- the oracle

ORACLE_CTES = f"""
demo14 AS (SELECT * FROM emp_demographics UNION ALL SELECT * FROM emp_demographics_added),
demo14u AS (
  SELECT EmployeeID, FirstName, LastName,
         CASE WHEN FirstName = '{EMP_UPDATE_FIRST}' AND LastName = '{EMP_UPDATE_LAST}'
              THEN {EMP_UPDATE_AGE} ELSE Age END AS Age,
         Gender
  FROM demo14),
demo15 AS (SELECT * FROM demo14u WHERE NOT coalesce(EmployeeID IS NULL, false)),
sal AS (SELECT * FROM emp_salary)"""

AVG_SAL = "CAST(SUM(CAST(Salary AS BIGINT)) // COUNT(Salary) AS INTEGER)"

ORACLE = {
    "emp_all": "SELECT * FROM emp_demographics",
    "sal_all": "SELECT * FROM sal",
    "emp_names": "SELECT FirstName, LastName, Age FROM emp_demographics",
    "emp_over_30": "SELECT * FROM emp_demographics WHERE Age > 30",
    "emp_female": "SELECT * FROM emp_demographics WHERE Gender = 'Female'",
    "sal_over_50k": "SELECT * FROM sal WHERE Salary > 50000",
    "emp_by_age": "SELECT * FROM emp_demographics ORDER BY Age ASC NULLS FIRST",
    "sal_desc": "SELECT * FROM sal ORDER BY Salary DESC NULLS LAST",
    "emp_salary_join": "SELECT d.EmployeeID, d.FirstName, d.LastName, s.JobTitle, s.Salary "
                       "FROM demo14 d INNER JOIN sal s ON d.EmployeeID = s.EmployeeID",
    "emp_salary_left": "SELECT d.*, s.EmployeeID AS SalaryEmployeeID, s.JobTitle, s.Salary "
                       "FROM demo14 d LEFT JOIN sal s ON d.EmployeeID = s.EmployeeID",
    "emp_salary_right": "SELECT d.*, s.EmployeeID AS SalaryEmployeeID, s.JobTitle, s.Salary "
                        "FROM demo14 d RIGHT JOIN sal s ON d.EmployeeID = s.EmployeeID",
    "emp_union": "SELECT FirstName, LastName, Age FROM demo14 UNION "
                 "SELECT FirstName, LastName, Age FROM emp_warehouse",
    "emp_age_category": "SELECT FirstName, LastName, Age, CASE WHEN Age > 30 THEN 'Old' "
                        "WHEN Age BETWEEN 27 AND 30 THEN 'Adult' ELSE 'Young' END AS AgeCategory "
                        "FROM demo14",
    "sal_avg": f"SELECT {AVG_SAL} AS AverageSalary FROM sal",
    "emp_count": "SELECT COUNT(EmployeeID) AS TotalEmployees FROM demo14",
    "sal_avg_by_job": f"SELECT JobTitle, {AVG_SAL} AS AvgSalary FROM sal GROUP BY JobTitle",
    "emp_update": "SELECT * FROM demo14u",
    "emp_delete": "SELECT * FROM demo15",
    "emp_fk_orphans": "SELECT * FROM sal s WHERE NOT EXISTS "
                      "(SELECT 1 FROM demo15 d WHERE d.EmployeeID = s.EmployeeID)",
    "sal_with_avg_scalar": f"SELECT EmployeeID, Salary, (SELECT {AVG_SAL} FROM sal) "
                           "AS AllAvgSalary FROM sal",
    "sal_with_avg_window": f"SELECT a.EmployeeID, a.AllAvgSalary FROM (SELECT EmployeeID, "
                           f"Salary, (SELECT {AVG_SAL} FROM sal) AS AllAvgSalary FROM sal) a "
                           "ORDER BY a.EmployeeID",
    "sal_semi_over_30": "SELECT EmployeeID, JobTitle, Salary FROM sal WHERE EmployeeID IN "
                        "(SELECT EmployeeID FROM demo15 WHERE Age > 30)",
    "sal_rank": "SELECT EmployeeID, JobTitle, Salary, CAST(RANK() OVER (ORDER BY Salary DESC "
                "NULLS LAST) AS BIGINT) AS SalaryRank FROM sal",
    "sal_rank_by_job": "SELECT EmployeeID, JobTitle, Salary, CAST(RANK() OVER (PARTITION BY "
                       "JobTitle ORDER BY Salary DESC NULLS LAST) AS BIGINT) AS RankByJob "
                       "FROM sal",
    "emp_cte_avg": "SELECT FirstName, JobTitle, Salary, AvgSalary FROM (SELECT d.EmployeeID, "
                   "d.FirstName, s.JobTitle, s.Salary, "
                   "CAST(SUM(CAST(s.Salary AS BIGINT)) OVER () // COUNT(s.Salary) OVER () "
                   "AS INTEGER) AS AvgSalary FROM demo15 d JOIN sal s "
                   "ON d.EmployeeID = s.EmployeeID) cte",
    "job_summary_temp": "SELECT s.JobTitle, COUNT(*) AS EmployeesPerJob, "
                        "CAST(SUM(CAST(d.Age AS BIGINT)) // COUNT(d.Age) AS INTEGER) AS AvgAge, "
                        "CAST(SUM(CAST(s.Salary AS BIGINT)) // COUNT(s.Salary) AS INTEGER) "
                        "AS AvgSalary FROM demo15 d JOIN sal s ON d.EmployeeID = s.EmployeeID "
                        "GROUP BY s.JobTitle",
    "emp_top3_salary": "SELECT * FROM (SELECT d.FirstName, s.JobTitle, s.Salary, "
                       "CAST(RANK() OVER (ORDER BY s.Salary DESC NULLS LAST) AS BIGINT) "
                       "AS SalaryRank FROM demo15 d JOIN sal s ON d.EmployeeID = s.EmployeeID) r "
                       "WHERE SalaryRank <= 3",
}

RECIPES = ["emp_demographics", "emp_demographics_added", "emp_salary", "emp_warehouse"]


def oracle_sql(key: str) -> str:
    return fixtures.duckdb_with(RECIPES, ORACLE[key], extra=ORACLE_CTES)


def queries():
    out = {}
    for key, stmt in STATEMENTS.items():
        out[key] = ((lambda f: lambda s, d: f(load(s, d)))(stmt), oracle_sql(key))
    return out

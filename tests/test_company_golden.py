"""Weeks 13-15 on the reference's own inline rows; expected values worked out by hand."""

import pytest

from tablewright.plans import company as CO

DEMO = [(1001, "Jim", "Halpert", 30, "Male"), (1002, "Pam", "Beasley", 30, "Female"),
        (1003, "Dwight", "Schrute", 29, "Male"), (1004, "Angela", "Martin", 31, "Female"),
        (1005, "Toby", "Flenderson", 32, "Male"), (1006, "Michael", "Scott", 35, "Male"),
        (1007, "Meredith", "Palmer", 32, "Female"), (1008, "Stanley", "Hudson", 38, "Male"),
        (1009, "Kevin", "Malone", 31, "Male")]
ADDED = [(1011, "Ryan", "Howard", 26, "Male"), (1012, "Holly", "Flax", None, None),
         (1013, "Darryl", "Philbin", None, "Male")]
SALARY = [(1001, "Salesman", 45000), (1002, "Receptionist", 36000), (1003, "Salesman", 63000),
          (1004, "Accountant", 47000), (1005, "HR", 50000), (1006, "Regional Manager", 65000),
          (1007, "Supplier Relations", 41000), (1008, "Salesman", 48000),
          (1009, "Accountant", 42000)]
WAREHOUSE = [(1013, "Darryl", "Philbin", None, "Male"), (1050, "Roy", "Anderson", 31, "Male"),
             (1051, "Hidetoshi", "Hasagawa", 40, "Male"), (1052, "Val", "Johnson", 31, "Female")]
DEMO_SCHEMA = "EmployeeID int, FirstName string, LastName string, Age int, Gender string"


@pytest.fixture(scope="module")
def company(spark):
    return CO.Company(
        demographics=spark.createDataFrame(DEMO, DEMO_SCHEMA),
        added=spark.createDataFrame(ADDED, DEMO_SCHEMA),
        salary=spark.createDataFrame(SALARY, "EmployeeID int, JobTitle string, Salary int"),
        warehouse=spark.createDataFrame(WAREHOUSE, DEMO_SCHEMA),
        update_first="Ryan", update_last="Howard", update_age=31)


def run(company, key):
    return CO.STATEMENTS[key](company).collect()


def ids(rows):
    return sorted(r["EmployeeID"] for r in rows)


def test_filters(company):
    assert ids(run(company, "emp_over_30")) == [1004, 1005, 1006, 1007, 1008, 1009]
    assert ids(run(company, "emp_female")) == [1002, 1004, 1007]
    assert sorted((r.EmployeeID, r.Salary) for r in run(company, "sal_over_50k")) == [
        (1003, 63000), (1006, 65000)]


def test_joins_and_union(company):
    assert len(run(company, "emp_salary_join")) == 9
    left = run(company, "emp_salary_left")
    assert len(left) == 12
    assert sorted(r.EmployeeID for r in left if r.Salary is None) == [1011, 1012, 1013]
    assert len(run(company, "emp_salary_right")) == 9
    assert len(run(company, "emp_union")) == 15


def test_age_category_null_is_young(company):
    cats = {r.FirstName: r.AgeCategory for r in run(company, "emp_age_category")}
    assert {n for n, c in cats.items() if c == "Old"} == {
        "Angela", "Toby", "Michael", "Meredith", "Stanley", "Kevin"}
    assert {n for n, c in cats.items() if c == "Adult"} == {"Jim", "Pam", "Dwight"}
    assert {n for n, c in cats.items() if c == "Young"} == {"Ryan", "Holly", "Darryl"}


def test_integer_averages(company):
    assert run(company, "sal_avg")[0].AverageSalary == 48555
    assert run(company, "emp_count")[0].TotalEmployees == 12
    by_job = {r.JobTitle: r.AvgSalary for r in run(company, "sal_avg_by_job")}
    assert by_job == {"Salesman": 52000, "Accountant": 44500, "Receptionist": 36000, "HR": 50000,
                      "Regional Manager": 65000, "Supplier Relations": 41000}
    assert {r.AllAvgSalary for r in run(company, "sal_with_avg_scalar")} == {48555}
    assert {r.AllAvgSalary for r in run(company, "sal_with_avg_window")} == {48555}


def test_update_and_delete(company):
    ages = {r.EmployeeID: r.Age for r in run(company, "emp_update")}
    assert ages[1011] == 31 and ages[1012] is None
    assert len(run(company, "emp_delete")) == 12
    assert run(company, "emp_fk_orphans") == []


def test_subqueries_and_ranks(company):
    assert ids(run(company, "sal_semi_over_30")) == [1004, 1005, 1006, 1007, 1008, 1009]
    ranks = sorted((r.Salary, r.SalaryRank) for r in run(company, "sal_rank"))
    assert [k for _, k in sorted(ranks, reverse=True)] == [1, 2, 3, 4, 5, 6, 7, 8, 9]
    by_job = {r.EmployeeID: r.RankByJob for r in run(company, "sal_rank_by_job")}
    assert (by_job[1003], by_job[1008], by_job[1001]) == (1, 2, 3)
    assert (by_job[1004], by_job[1009]) == (1, 2)
    assert all(by_job[i] == 1 for i in (1002, 1005, 1006, 1007))


def test_temp_table_and_top3(company):
    rows = {r.JobTitle: (r.EmployeesPerJob, r.AvgAge, r.AvgSalary)
            for r in run(company, "job_summary_temp")}
    assert rows == {"Salesman": (3, 32, 52000), "Accountant": (2, 31, 44500),
                    "Receptionist": (1, 30, 36000), "HR": (1, 32, 50000),
                    "Regional Manager": (1, 35, 65000), "Supplier Relations": (1, 32, 41000)}
    top = sorted((r.SalaryRank, r.FirstName, r.Salary) for r in run(company, "emp_top3_salary"))
    assert top == [(1, "Michael", 65000), (2, "Dwight", 63000), (3, "Toby", 50000)]

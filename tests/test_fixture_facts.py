"""Facts FIXTURES.md states about the derived inputs at sf0.01."""

from decimal import Decimal

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def q(spark):
    return lambda key: entry.queries()[key](spark, SF).collect()


def test_hr_facts(q):
    status = {r.employee_status: r.total_employees for r in q("hr_status_counts")}
    assert status == {"Active": 12749, "Terminated": 2251}
    miss = q("hr_missing_values")[0]
    assert (miss.total_records, miss.missing_birthdate, miss.missing_hire_date) == (15000, 322, 149)
    tenure = [r.tenure_years for r in q("hr_tenure_counts")]
    assert min(tenure) == -5 and max(tenure) == 21
    ages = [r.age for r in q("hr_age_counts")]
    assert min(ages) == 15 and max(ages) == 60
    rec = {r.department: (r.attrition_rate_percentage, r.average_tenure_years)
           for r in q("hr_recommendation")}
    assert rec["FURNITURE"] == (Decimal("28.80"), Decimal("4.23"))
    assert rec["HOUSEHOLD"] == (Decimal("20.71"), Decimal("9.12"))
    assert rec["AUTOMOBILE"] == (Decimal("12.14"), Decimal("9.39"))
    assert rec["MACHINERY"][0] == Decimal("8.65") and rec["BUILDING"][0] == Decimal("4.70")
    assert len(q("hr_jobtitle_counts")) == 125


def test_retail_facts(q):
    counts = {r.TableName: r.TotalRows for r in q("norm_row_counts")}
    assert counts == {"Customers": 1500, "Products": 2000, "Orders": 14743, "OrderDetails": 60000}
    assert len(q("cust_in_state")) == 286
    assert len(q("norm_pk_violations")) == 55
    assert len(q("orders_in_february")) == 195
    assert len(q("orders_of_customer")) == 19
    assert len(q("quantity_by_product")) == 64


def test_notebook_facts(q):
    assert len(q("countries_clean")) == 25
    before = {(r.dataset, r.stage): r for r in q("quality_before_after")}
    assert before[("population", "before")].rows == 1575
    assert before[("population", "before")].duplicate_rows == 75
    assert len(q("movies_clean")) == 2000

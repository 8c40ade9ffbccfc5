"""HR landing table -> typed clean table -> derived columns.

The reference copies the text table into a typed one and then fills three
columns in three UPDATE passes; here it is one ``select``, one pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import completed_years, try_date, try_datetime_utc_text

# The all-text landing table's columns, in file order.
RAW_COLUMNS = ["id", "first_name", "last_name", "birthdate", "gender", "race", "department",
               "jobtitle", "location", "hire_date", "termdate", "location_city",
               "location_state"]

TEXT_COLUMNS = ["id", "first_name", "last_name", "gender", "race", "department",
                "jobtitle", "location", "location_city", "location_state"]


def clean(raw: DataFrame) -> DataFrame:
    """Typed copy of the all-text landing table (SELECT ... INTO hr_data_clean)."""
    return raw.select(
        *TEXT_COLUMNS,
        try_date("birthdate").alias("birthdate"),
        try_date("hire_date").alias("hire_date"),
        try_datetime_utc_text("termdate").alias("termdate"),
    )


def as_of_literal(as_of: str) -> Column:
    """The report date that stands in for GETDATE(), as a fixed parameter."""
    return F.lit(as_of).cast("timestamp_ntz")


def status(termdate: Column, now: Column) -> Column:
    """Active when there is no termdate or it is in the future."""
    return (F.when(termdate.isNull(), F.lit("Active"))
            .when(termdate > now, F.lit("Active"))
            .otherwise(F.lit("Terminated")))


def derive(clean_df: DataFrame, as_of: str) -> DataFrame:
    """Add employee_status, age and tenure_years as of ``as_of``."""
    now = as_of_literal(as_of)
    term = F.col("termdate")
    hire = F.col("hire_date")
    still_employed = term.isNull() | (term > now)
    tenure = (F.when(hire.isNull(), F.lit(None).cast("int"))
              .when(still_employed, completed_years(hire, now))
              .otherwise(completed_years(hire, term)))
    return clean_df.withColumns({
        "employee_status": status(term, now),
        "age": F.when(F.col("birthdate").isNotNull(),
                      completed_years("birthdate", now)),
        "tenure_years": tenure,
    })


def bad_rows(emp: DataFrame) -> DataFrame:
    """Rows with missing dates or age, or negative tenure (quality report)."""
    return emp.filter(F.col("hire_date").isNull() | F.col("birthdate").isNull()
                      | F.col("age").isNull() | (F.col("tenure_years") < 0))

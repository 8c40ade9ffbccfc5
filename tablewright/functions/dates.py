"""Date functions of the HR script (F4-F10), as JVM-side column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def try_date(c: Column | str, fmt: str = "yyyy-MM-dd") -> Column:
    """TRY_CONVERT(DATE, LTRIM(RTRIM(x)), 23): bad or empty text -> NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.try_to_date(F.trim(c), fmt)


def try_datetime_utc_text(c: Column | str) -> Column:
    """TRY_CONVERT(DATETIME, NULLIF(REPLACE(LTRIM(RTRIM(x)), ' UTC', ''), '')).

    The " UTC" suffix is text that is dropped; there is no zone conversion.
    """
    c = F.col(c) if isinstance(c, str) else c
    text = F.nullif(F.replace(F.trim(c), F.lit(" UTC"), F.lit("")), F.lit(""))
    return text.try_cast("timestamp_ntz")


def completed_years(start: Column | str, end: Column | str) -> Column:
    """Whole years from ``start`` (a date) to ``end`` (age / tenure).

    DATEDIFF(YEAR) counts year boundaries; one is taken off when the
    anniversary DATEADD(YEAR, n, start) -- Feb 29 becomes Feb 28, as with
    ``add_months`` -- falls after ``end``. Negative when ``end`` is earlier.
    Pure date arithmetic, so the session time zone plays no part.
    """
    start = F.col(start) if isinstance(start, str) else start
    end = F.col(end) if isinstance(end, str) else end
    n = F.year(end) - F.year(start)
    anniversary = F.add_months(start, n * 12).cast("timestamp_ntz")
    return (n - F.when(anniversary > end.cast("timestamp_ntz"), 1).otherwise(0)).cast("int")

"""DuckDB forms of the report expressions, for the independent SQL oracle.

DuckDB turns ``n * 100.0 / d`` into a DOUBLE and then rounds some exact
ties down, so rates and averages are rounded half up in integer arithmetic.
"""

from __future__ import annotations


def pct(num: str, den: str) -> str:
    """CAST(num * 100.0 / den AS DECIMAL(10,2)), half up, for num, den >= 0."""
    return (f"CAST(CAST((CAST({num} AS BIGINT) * 20000 + CAST({den} AS BIGINT)) "
            f"// (2 * CAST({den} AS BIGINT)) AS DECIMAL(18,0)) * 0.01 AS DECIMAL(10,2))")


def avg2(col: str) -> str:
    """Average of an integer column rounded half up (away from zero) to 2 places."""
    s = f"SUM(CAST({col} AS BIGINT))"
    n = f"COUNT({col})"
    return (f"CAST(sign({s}) * CAST((abs({s}) * 200 + {n}) // (2 * {n}) AS DECIMAL(18,0)) "
            f"* 0.01 AS DECIMAL(10,2))")


def band(col: str, bands, unknown: str = "Unknown") -> str:
    parts = []
    for label, op, value in bands:
        if op == "between":
            cond = f"{col} BETWEEN {value[0]} AND {value[1]}"
        else:
            cond = f"{col} {op} {value}"
        parts.append(f"WHEN {cond} THEN '{label}'")
    return "CASE " + " ".join(parts) + f" ELSE '{unknown}' END"


def years_between(start: str, end: str) -> str:
    """DATEDIFF(YEAR) counts boundaries; subtract one when the anniversary is later."""
    s = f"CAST({start} AS TIMESTAMP)"
    e = f"CAST({end} AS TIMESTAMP)"
    d = f"date_diff('year', {s}, {e})"
    return f"({d} - CASE WHEN {s} + to_years(CAST({d} AS INTEGER)) > {e} THEN 1 ELSE 0 END)"


def order_by(order) -> str:
    """ORDER BY with Spark's null placement (first ascending, last descending)."""
    if not order:
        return ""
    items = [f"{k} DESC NULLS LAST" if d else f"{k} ASC NULLS FIRST" for k, d in order]
    return "ORDER BY " + ", ".join(items)

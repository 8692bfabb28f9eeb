"""Comparison rounding shared by the named queries and their SQL twins.

Values that depend on summation order are compared at 6 decimals by the same
arithmetic in both engines (their round() functions differ near halves).  The
offset lies a little above a half: means of values with few decimals often
sit exactly on a half, and would fall to either side with the order of the sum.
Values too large for 6 decimals are compared as they are.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OFFSET, LARGE = 0.5001, 1e9


def r6(col) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    small = F.abs(c) < F.lit(LARGE)
    return F.when(small & ~F.isnan(c), F.floor(c * F.lit(1e6) + F.lit(OFFSET)).cast("double") / F.lit(1e6)).otherwise(c)


def r6_sql(expression: str) -> str:
    e = f"({expression})"
    return (f"(CASE WHEN abs{e} < CAST('{LARGE!r}' AS DOUBLE) AND NOT isnan{e} THEN "
            f"floor({e} * CAST('1000000.0' AS DOUBLE) + CAST('{OFFSET!r}' AS DOUBLE)) / CAST('1000000.0' AS DOUBLE) ELSE {e} END)")

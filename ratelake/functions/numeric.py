"""Exact fixed-point aggregates.

``exact_mean(c, decimals, shift)`` is the mean of column ``c`` (a value with
``decimals`` fractional digits) divided by ``10**shift``, rounded HALF_UP
(away from zero) to 8 decimals, computed on integers only: the sum of the
scaled values and one integer division. Every engine gets the same digits,
also for means that fall exactly on a rounding half, where a floating-point
mean may land on either side.

The mean is algebraic: ``scaled_int`` sums and counts can be pre-aggregated
at any grain (e.g. per customer-month before a join) and finished later with
``exact_mean_from`` over the summed sums and counts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OUT_SCALE = 8


def scaled_int(col: str, decimals: int = 2) -> Column:
    """The value as an integer count of ``10**-decimals`` units."""
    return F.expr(f"CAST(CAST({col} AS DECIMAL(18,{decimals})) * {10 ** decimals} AS BIGINT)")


def whole_number(value: Column) -> Column:
    """A DOUBLE rounded to BIGINT; NULL where BIGINT can't hold it (a plain cast ends the query there)."""
    r = F.round(value)
    return F.when((r >= -(2.0**63)) & (r < 2.0**63), r.cast("bigint"))


def exact_mean_from(sum_sql: str, count_sql: str, decimals: int = 2, shift: int = 0) -> Column:
    """Finish the mean from SQL aggregate expressions of the scaled sum and count."""
    up = OUT_SCALE - decimals - shift
    if up < 0:
        raise ValueError("shift too large for an 8-decimal result")
    num = f"({sum_sql} * {10 ** up})"
    den = f"nullif({count_sql}, 0)"
    units = f"(CAST(signum({num}) AS BIGINT) * ((2 * abs({num}) + {den}) div (2 * {den})))"
    return F.expr(f"CAST(CAST({units} AS DECIMAL(18,0)) / {10 ** OUT_SCALE} AS DECIMAL(18,{OUT_SCALE}))")


def exact_mean(col: str, decimals: int = 2, shift: int = 0) -> Column:
    scaled = f"CAST(CAST({col} AS DECIMAL(18,{decimals})) * {10 ** decimals} AS BIGINT)"
    return exact_mean_from(f"sum({scaled})", f"count({col})", decimals, shift)

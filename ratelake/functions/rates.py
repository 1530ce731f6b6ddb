"""Rates algebra on percent numbers (0.05 means 0.05 %, not 5 %).

A *factor* is ``1 + rate/100``. Compounding multiplies factors; the product
is taken as ``exp(sum(ln f))`` so that it is an ordinary, partially
aggregatable SUM (map-side combine, mergeable across partitions, usable in
window frames). ``ln`` of a non-positive factor is NULL in Spark and SUM would
skip it silently, so callers that care count ``log_factor IS NULL`` as a
quality violation instead of trusting the product, or take ``product``, which
multiplies factors of any sign and is as mergeable.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def factor(rate: str | Column) -> Column:
    """Percent rate -> capitalisation factor ``1 + rate/100``."""
    return F.lit(1) + _c(rate) / F.lit(100)


def log_factor(rate: str | Column) -> Column:
    """Natural log of the factor; NULL when the factor is not positive."""
    return F.log(factor(rate))


def to_percent(fac: str | Column) -> Column:
    """Factor -> percent rate ``(f - 1) * 100``."""
    return (_c(fac) - F.lit(1)) * F.lit(100)


def compound(rate: str | Column) -> Column:
    """Aggregate: product of the factors of ``rate`` (a DOUBLE factor)."""
    return F.exp(F.sum(log_factor(rate)))


def compound_rate(rate: str | Column) -> Column:
    """Aggregate: effective rate of the period, in percent."""
    return to_percent(compound(rate))


def product(fac: str | Column, over: Callable[[Column], Column] = lambda c: c) -> Column:
    """Aggregate: product of factors of any sign; NULL factors are left out, none at all gives NULL.

    Factors are multiplied, so products of whole numbers are exact up to 2**53.
    Where their logarithms' magnitudes add up to more than a DOUBLE's range, so
    that a part of the product might leave it on the way, the logarithms are
    added and the negative factors counted instead. All are ordinary
    aggregates. ``over`` puts each of them over a window.
    """
    f = _c(fac).cast("double")
    log = F.when(f != 0, F.log(F.abs(f)))
    negative = over(F.count(F.when(f < 0, F.lit(1)))) % 2 == 1
    size = F.exp(over(F.sum(log)))
    whole = F.when(over(F.sum(F.abs(log))) <= 700, over(F.product(F.when(f != 0, f)))).when(negative, -size).otherwise(size)
    out = F.when(over(F.count(F.when(f == 0, F.lit(1)))) > 0, F.lit(0.0)).otherwise(whole)
    return F.when(over(F.count(f)) > 0, out)

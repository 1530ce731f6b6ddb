"""Rollups of long observation tables, one measure list for any number of series.

Input is ``(series_name, year_month, value, ...)``. One scan, one shuffle, no
join: each measure is a conditional aggregate over its series. All aggregates
are algebraic, so a month that holds a third of all rows is still reduced to
one partial row per map task. A month without rows of a measure's series gets
NULL for that measure, as an outer join of single rollups would give.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelake.functions.rates import factor, log_factor, product
from ratelake.settings import VALUE_TYPE


@dataclass(frozen=True)
class Measure:
    """``kind``: mean or sum (cast to the value type), count, or factor, the
    product of (1 + rate/100) over the observations there are; product is the
    same for rates at or below -100 %, whose factors are not positive."""

    column: str
    series: str
    kind: str

    def over(self, value: Column, series: Column, value_type: str) -> Column:
        own = series == self.series
        if self.kind == "count":
            return F.nullif(F.count_if(own), F.lit(0)).cast("int")
        if self.kind == "factor":
            return F.exp(F.sum(F.when(own, log_factor(value))))
        if self.kind == "product":
            return product(F.when(own, factor(value)))
        return {"mean": F.avg, "sum": F.sum}[self.kind](F.when(own, value)).cast(value_type)


def policy_measures(series: str) -> list[Measure]:
    return [Measure("policy_mean_day", series, "mean"), Measure("policy_days", series, "count"), Measure("policy_factor", series, "factor")]


def inflation_measures(series: str) -> list[Measure]:
    return [Measure("inflation_month", series, "sum"), Measure("inflation_factor", series, "factor")]


def rollup(
    obs: DataFrame,
    measures: Sequence[Measure],
    *,
    by: Sequence[str] = (),
    period: str = "year_month",
    series_col: str = "series_name",
    value_col: str = "value",
    value_type: str = VALUE_TYPE,
) -> DataFrame:
    """One row per ``by`` and period with every measure."""
    used = sorted({m.series for m in measures})
    aggs = [m.over(F.col(value_col), F.col(series_col), value_type).alias(m.column) for m in measures]
    return obs.where(F.col(series_col).isin(used)).groupBy(*by, period).agg(*aggs)

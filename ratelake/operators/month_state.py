"""Silver summed up by series and month: what the rules count and what Gold adds up.

Every number is algebraic over rows or distinct inside the month, so a month's
row depends on that month's rows alone: after a merge only the months in
rewritten folders are summed up again, and the rules and the monthly rates of
the whole table are sums over a few rows per series and year.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelake.functions.parsing import month_start
from ratelake.functions.rates import log_factor
from ratelake.settings import VALUE_TYPE, SeriesSpec

REQUIRED = ("series_id", "series_name", "granularity", "ref_date", "year_month", "value")


def domain_digest(series: Sequence[SeriesSpec]) -> str:
    """Changes when a value domain does: ``out_of_domain`` of older rows then means another thing."""
    return hashlib.md5(repr(sorted((s.name, *s.domain) for s in series)).encode()).hexdigest()


def month_state(rows: DataFrame, series: Sequence[SeriesSpec], layout: Sequence[str] = ()) -> DataFrame:
    """One row per series and month (see ``schemas.MONTH_STATE``), with the layout's columns.

    A month holds few days, so counting its different days stays small however
    many rows it has.
    """
    name, value, day = F.col("series_name"), F.col("value"), F.col("ref_date")
    gap, outside = F.lit(False), F.lit(False)
    for c in REQUIRED:
        gap = gap | F.col(c).isNull()
    for s in series:
        low, high = s.domain
        outside = outside | ((name == s.name) & ((value < F.lit(low)) | (value > F.lit(high))))
    summed = rows.groupBy(*layout, "series_id", "series_name", "year_month").agg(
        F.count(F.lit(1)).alias("rows"),
        # NULL is a value of the key: it counts as one more day
        (F.count_distinct(day) + F.coalesce(F.max(day.isNull().cast("int")), F.lit(0))).cast("bigint").alias("keys"),
        F.count_if(gap).alias("nulls"),
        F.count_if(outside).alias("out_of_domain"),
        F.count_if(F.dayofmonth(day) != 1).alias("not_day_1"),
        F.count_if(value <= -100).alias("not_above_minus_100"),
        F.sum(value).cast("decimal(38,8)").alias("value_sum"),
        F.count(value).alias("value_count"),
        F.sum(log_factor(value)).alias("log_sum"),
    )
    return summed.withColumn("domain_digest", F.lit(domain_digest(series)))


def monthly_rates_of_state(state: DataFrame, policy_series: str, inflation_series: str, value_type: str = VALUE_TYPE) -> DataFrame:
    """The monthly rates that ``plans.gold.monthly_rates`` takes from Silver, from the state alone."""
    pol, infl = F.col("series_name") == policy_series, F.col("series_name") == inflation_series
    total = lambda own, c: F.sum(F.when(own, F.col(c)))
    m = state.where(pol | infl).groupBy("year_month").agg(
        # avg() of an 18,8 decimal has 12 places before the cast to the value type
        (total(pol, "value_sum") / total(pol, "value_count")).cast("decimal(22,12)").cast(value_type).alias("policy_mean_day"),
        total(pol, "rows").cast("int").alias("policy_days"),
        F.exp(total(pol, "log_sum")).alias("policy_factor"),
        total(infl, "value_sum").cast(value_type).alias("inflation_month"),
        F.exp(total(infl, "log_sum")).alias("inflation_factor"),
    )
    return m.withColumn("month_start", month_start("year_month")).withColumn("real_factor", F.col("policy_factor") / F.col("inflation_factor"))

"""One-row numbers of the layers, as plain columns.

They are sums over what the rules read as well: the counts per landing file
(``streaming.ledger.file_counts``) and the month state, here taken from the
rows of any Bronze or Silver, so each measure is written once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelake.operators.conform import rejection_counts
from ratelake.operators.month_state import month_state
from ratelake.settings import Settings
from ratelake.streaming.ledger import file_counts


def _total(c: str | Column, where: Column | None = None) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.sum(c if where is None else F.when(where, c)), F.lit(0)).cast("bigint")


def bronze_metrics(bronze: DataFrame, settings: Settings, landing_files: Column) -> DataFrame:
    """Two levels: per source file (partial aggregation map-side, so a file that
    holds a third of all rows costs one row per task in the shuffle), then over the files."""
    return file_counts(bronze, settings).agg(
        _total("rows").alias("bronze_rows"),
        _total("no_provenance").alias("missing_provenance"),
        F.count("source_file").alias("distinct_files"),
        F.count_distinct("series_name").alias("distinct_series"),
        _total("no_raw_field").alias("empty_rows"),
    ).withColumn("landing_files", landing_files.cast("bigint"))


def silver_metrics(silver: DataFrame, settings: Settings, bronze: DataFrame | None = None) -> DataFrame:
    month, series = F.col("year_month"), F.col("series_name")
    infl, pol = series == settings.inflation_series, series == settings.policy_series
    outside = (month < settings.first_month) | (month > settings.last_month)
    m = month_state(silver, settings.series).agg(
        _total("rows").alias("silver_rows"),
        _total("keys").alias("distinct_keys"),
        _total("out_of_domain").alias("out_of_domain"),
        _total("rows", outside).alias("out_of_window"),
        F.count_distinct(F.when(infl, month)).alias("inflation_months"),
        _total("not_day_1", infl).alias("inflation_not_day1"),
        F.count_if(pol & (F.col("rows") < settings.min_policy_days_per_month)).alias("thin_policy_months"),
        _total("not_above_minus_100").alias("nonpositive_factors"),
        _total("nulls").alias("null_required"),
    )
    if bronze is None:
        return m
    counts = rejection_counts(bronze, settings.series, date_format=settings.raw_date_format, value_type=settings.value_type)
    return m.withColumns({c: counts.select(c).scalar() for c in ("rejected_rows", "unmapped_rows")})


def gold_metrics(gold: DataFrame, settings: Settings) -> DataFrame:
    one = lambda c: 1 + F.col(c) / 100
    gap = F.abs(one("real_month") * one("inflation_month") - one("policy_month"))
    missing = F.lit(False)
    for c in ("policy_mean_day", "policy_month", "inflation_month", "real_month"):
        missing = missing | F.col(c).isNull()
    return gold.agg(
        F.count(F.lit(1)).alias("gold_rows"),
        F.count_distinct("year_month").alias("distinct_months"),
        F.count_if(missing).alias("missing_metrics"),
        F.count("real_12m").alias("filled_rolling"),
        F.count_if(gap > settings.fisher_tolerance).alias("fisher_violations"),
        F.count_if(F.col("policy_days") < settings.min_policy_days_per_month).alias("thin_policy_months"),
    )

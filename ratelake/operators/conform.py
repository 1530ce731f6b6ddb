"""Bronze -> Silver conformance: map file to series, type tolerantly, dedup.

* series metadata comes from the landing file path (payload has no id),
  mapped once a file and joined;
* ``try_to_date`` / ``try_cast`` turn malformed text into NULL, the row is
  dropped here and *counted* by the quality checks (``rejected``,
  ``unmapped``), which decide whether the run stops;
* one row per ``(series_id, ref_date)`` survives: the latest ingest, with
  file modification time, file name and value as tie-breakers so that ties
  inside one ingest batch resolve the same way on every run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelake.functions.parsing import parse_date, parse_decimal, year_month
from ratelake.functions.series import join_series, with_series
from ratelake.operators.dedup import latest_wins
from ratelake.schemas import SILVER_KEY
from ratelake.settings import RAW_DATE_FORMAT, VALUE_TYPE, SeriesSpec


def typed(
    bronze: DataFrame,
    series: Sequence[SeriesSpec],
    *,
    date_format: str = RAW_DATE_FORMAT,
    value_type: str = VALUE_TYPE,
) -> DataFrame:
    """Every Bronze row, typed; failed conversions and unmapped files are NULL."""
    bronze = bronze.select("date_raw", "value_raw", "source_file", "file_modified_at", "ingested_at")
    return join_series(bronze, series, ("series_id", "name", "granularity")).select(
        "series_id",
        F.col("name").alias("series_name"),
        "granularity",
        parse_date("date_raw", date_format).alias("ref_date"),
        parse_decimal("value_raw", value_type).alias("value"),
        F.col("source_file"),
        F.col("file_modified_at"),
        F.col("ingested_at"),
    )


def usable(typed_rows: DataFrame) -> DataFrame:
    """Keep rows with a series, a date and a value."""
    return typed_rows.filter(
        F.col("series_id").isNotNull() & F.col("ref_date").isNotNull() & F.col("value").isNotNull()
    )


def rejected_predicate(date_format: str = RAW_DATE_FORMAT, value_type: str = VALUE_TYPE):
    """Raw row whose date OR value does not convert."""
    return parse_date("date_raw", date_format).isNull() | parse_decimal("value_raw", value_type).isNull()


def newest_first():
    return [
        F.col("ingested_at").desc_nulls_last(),
        F.col("file_modified_at").desc_nulls_last(),
        F.col("source_file").desc_nulls_last(),
        F.col("value").desc_nulls_last(),
    ]


def conform(
    bronze: DataFrame,
    series: Sequence[SeriesSpec],
    *,
    date_format: str = RAW_DATE_FORMAT,
    value_type: str = VALUE_TYPE,
    with_processed_at: bool = True,
) -> DataFrame:
    """Bronze -> de-duplicated Silver rows (the MERGE source)."""
    rows = usable(typed(bronze, series, date_format=date_format, value_type=value_type))
    out = latest_wins(rows, SILVER_KEY, newest_first()).withColumn("year_month", year_month("ref_date"))
    cols = [
        "series_id",
        "series_name",
        "granularity",
        "ref_date",
        "year_month",
        "value",
        "source_file",
        "ingested_at",
    ]
    if with_processed_at:
        out = out.withColumn("processed_at", F.current_timestamp())
        cols.append("processed_at")
    return out.select(*cols)


def rejection_counts(
    bronze: DataFrame,
    series: Sequence[SeriesSpec],
    *,
    date_format: str = RAW_DATE_FORMAT,
    value_type: str = VALUE_TYPE,
) -> DataFrame:
    """One row: Bronze rows, rejected (date or value bad), unmapped file."""
    per_file = bronze.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(rejected_predicate(date_format, value_type)).alias("rejected")
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return with_series(per_file, series, ("series_id",)).agg(
        total("n").alias("bronze_rows"),
        total("rejected").alias("rejected_rows"),
        total(F.when(F.col("series_id").isNull(), F.col("n"))).alias("unmapped_rows"),
    )

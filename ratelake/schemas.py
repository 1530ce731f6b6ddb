"""Declared schemas of the landing payload and the three layer tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Landing payload: both fields text, never inferred (the raw is preserved).
RAW_PAYLOAD = T.StructType(
    [
        T.StructField("data", T.StringType(), True),
        T.StructField("valor", T.StringType(), True),
    ]
)

# Bronze: one row per raw record, all business fields STRING, plus provenance.
BRONZE = T.StructType(
    [
        T.StructField("date_raw", T.StringType(), True),
        T.StructField("value_raw", T.StringType(), True),
        T.StructField("source_file", T.StringType(), True),
        T.StructField("file_modified_at", T.TimestampType(), True),
        T.StructField("ingested_at", T.TimestampType(), True),
    ]
)

# Silver: one row per (series_id, ref_date). NOT NULL is a quality check,
# since plain Parquet does not enforce it.
SILVER = T.StructType(
    [
        T.StructField("series_id", T.IntegerType(), True),
        T.StructField("series_name", T.StringType(), True),
        T.StructField("granularity", T.StringType(), True),
        T.StructField("ref_date", T.DateType(), True),
        T.StructField("year_month", T.StringType(), True),
        T.StructField("value", T.DecimalType(18, 8), True),
        T.StructField("source_file", T.StringType(), True),
        T.StructField("ingested_at", T.TimestampType(), True),
        T.StructField("processed_at", T.TimestampType(), True),
    ]
)
SILVER_KEY = ("series_id", "ref_date")
# Folders of Silver: they follow from the key, so a key never changes its folder.
SILVER_LAYOUT = {"ref_year": "year(ref_date)", "series_bucket": "pmod(series_id, {buckets})"}
SILVER_TEXT = "One observation per series and day; upserted by (series_id, ref_date), the newest ingest wins."

_RATE = T.DecimalType(18, 8)
GOLD = T.StructType(
    [
        T.StructField("year_month", T.StringType()),
        T.StructField("month_start", T.DateType()),
        T.StructField("policy_mean_day", _RATE),
        T.StructField("policy_days", T.IntegerType()),
        *[T.StructField(c, _RATE) for c in ("policy_month", "inflation_month", "real_month", "policy_12m", "inflation_12m", "real_12m")],
        T.StructField("months_in_window", T.IntegerType()),
        T.StructField("processed_at", T.TimestampType()),
    ]
)
GOLD_TEXT = "Monthly rates in percent: compounded, deflated by the ratio of factors, and over trailing windows."

# What a column holds, by table; a column without an entry speaks for itself.
COLUMN_TEXTS = {
    "value": "percent per day or month, as published",
    "year_month": "yyyy-MM",
    "ingested_at": "micro-batch time of the Bronze ingest",
    "policy_days": "observations in the month",
    "months_in_window": "rows in the trailing window",
}

# One row per landing file and ingest batch: what Bronze took from it.
LEDGER = (
    "source_file string, file_modified_at timestamp, ingested_at timestamp, rows bigint, no_provenance bigint, "
    "no_raw_field bigint, rejected bigint, series_id int, series_name string"
)

# One row per series and month of Silver: what the rules ask for and Gold adds up.
MONTH_STATE = (
    "series_id int, series_name string, year_month string, rows bigint, keys bigint, nulls bigint, out_of_domain bigint, "
    "not_day_1 bigint, not_above_minus_100 bigint, value_sum decimal(38,8), value_count bigint, log_sum double, domain_digest string"
)

# One row per write of a stored table.
AUDIT = "written_at timestamp, operation string, metrics map<string,string>"

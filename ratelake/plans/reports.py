"""Evidence reports over the layer tables (profiles, grain, replay, validation)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Official yearly inflation (%, December 12-month figure) used
# by the external validation of the published series.
OFFICIAL_YEARLY_INFLATION = (
    ("2020-12", "4.52"),
    ("2021-12", "10.06"),
    ("2022-12", "5.79"),
    ("2023-12", "4.62"),
    ("2024-12", "4.83"),
)


def bronze_profile(bronze: DataFrame) -> DataFrame:
    """Per source file: rows, first/last raw date (text order), last ingest."""
    return bronze.groupBy("source_file").agg(
        F.count(F.lit(1)).cast("bigint").alias("rows"),
        F.min("date_raw").alias("first_date_raw"),
        F.max("date_raw").alias("last_date_raw"),
        F.max("ingested_at").alias("last_ingested_at"),
    )


def bronze_sample(bronze: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` Bronze rows in a total order of all columns (a top-k, as a quick look)."""
    return bronze.orderBy("source_file", *[c for c in bronze.columns if c != "source_file"]).limit(n)


def silver_profile(silver: DataFrame) -> DataFrame:
    """Per series: rows, distinct dates, first/last date, last processing."""
    aggs = [
        F.count(F.lit(1)).cast("bigint").alias("rows"),
        F.count_distinct("ref_date").cast("bigint").alias("distinct_dates"),
        F.min("ref_date").alias("first_date"),
        F.max("ref_date").alias("last_date"),
    ]
    if "processed_at" in silver.columns:
        aggs.append(F.max("processed_at").alias("last_processed_at"))
    return silver.groupBy("series_name").agg(*aggs)


def first_observations(silver: DataFrame, series_name: str, n: int = 10) -> DataFrame:
    """Top-k: the first ``n`` observations of a series by date."""
    return silver.filter(F.col("series_name") == series_name).orderBy("ref_date").limit(n)


def december_view(gold: DataFrame, digits: int = 2) -> DataFrame:
    """12-month rates of each December, rounded (HALF_UP)."""
    t = f"decimal(18,{digits})"
    return (
        gold.filter(F.col("year_month").like("%-12"))
        .select(
            "year_month",
            F.round("inflation_12m", digits).cast(t).alias("inflation_12m"),
            F.round("policy_12m", digits).cast(t).alias("policy_12m"),
            F.round("real_12m", digits).cast(t).alias("real_12m"),
        )
        .orderBy("year_month")
    )


def monthly_view(gold: DataFrame) -> DataFrame:
    """Whole monthly table rounded for reading (6 places daily, 4 monthly, 2 yearly)."""

    def r(c: str, d: int):
        return F.round(c, d).cast(f"decimal(18,{d})").alias(c)

    return gold.select(
        "year_month",
        r("policy_mean_day", 6),
        "policy_days",
        r("policy_month", 4),
        r("inflation_month", 4),
        r("real_month", 4),
        r("policy_12m", 2),
        r("inflation_12m", 2),
        r("real_12m", 2),
    ).orderBy("year_month")


def layer_volumes(bronze: DataFrame, silver: DataFrame, gold: DataFrame) -> DataFrame:
    """Rows and distinct source files per layer (Gold has no file column)."""
    b = bronze.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("source_file").alias("files"))
    s = silver.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("source_file").alias("files"))
    g = gold.agg(F.count(F.lit(1)).alias("rows"))
    out = None
    for name, df in (("bronze", b), ("silver", s), ("gold", g)):
        df = df.select(F.lit(name).alias("layer"), "*")
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out.select("layer", F.col("rows").cast("bigint"), F.col("files").cast("bigint"))


def ingest_batches(bronze: DataFrame) -> DataFrame:
    """Per file: rows and distinct ingest batches (1 means never re-ingested)."""
    return bronze.groupBy("source_file").agg(
        F.count(F.lit(1)).cast("bigint").alias("rows"),
        F.count_distinct("ingested_at").cast("bigint").alias("ingest_batches"),
    )


def key_grain(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows vs distinct keys of any table.

    Grouping by the key (partial aggregation map-side, one shuffle of
    key-level partial counts) then summing: no row expansion, and a key that
    holds a third of all rows becomes one row per map task. ``distinct_keys``
    counts every key like DISTINCT does (a key with a NULL part is a key);
    ``distinct_complete_keys`` is ``COUNT(DISTINCT a, b)``, which skips keys
    with a NULL part; ``duplicate_rows`` is rows beyond one per key.
    """
    complete = F.lit(True)
    for k in keys:
        complete = complete & F.col(k).isNotNull()
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows"),
        F.count(F.lit(1)).cast("bigint").alias("distinct_keys"),
        F.count_if(complete).cast("bigint").alias("distinct_complete_keys"),
    ).withColumn("duplicate_rows", F.col("rows") - F.col("distinct_keys"))


def grain_report(silver: DataFrame, gold: DataFrame, key: Sequence[str] = ("series_id", "ref_date")) -> DataFrame:
    """Declared vs actual grain: rows and distinct keys of Silver and Gold.

    Distinct keys count NULL-bearing keys too (DISTINCT over the key, not
    ``COUNT(DISTINCT a, b)``, which skips any key with a NULL part).
    """
    out = None
    for name, df, keys in (("silver", silver, list(key)), ("gold", gold, ["year_month"])):
        g = key_grain(df, keys).select(F.lit(name).alias("table_name"), "rows", "distinct_keys")
        out = g if out is None else out.unionByName(g)
    return out


REFERENCE_SCHEMA = T.StructType(
    [T.StructField("year_month", T.StringType(), False), T.StructField("reference", T.DecimalType(18, 2), False)]
)


def official_reference(spark: SparkSession) -> DataFrame:
    from decimal import Decimal

    rows = [(ym, Decimal(v)) for ym, v in OFFICIAL_YEARLY_INFLATION]
    return spark.createDataFrame(rows, REFERENCE_SCHEMA)


def external_validation(gold: DataFrame, reference: DataFrame, digits: int = 2) -> DataFrame:
    """Gold 12-month inflation vs reference yearly values (inner join on month).

    The reference side is one row per year; AQE broadcasts it when its
    measured size is under the broadcast threshold.
    """
    t = f"decimal(18,{digits})"
    return (
        gold.join(reference, "year_month")
        .select(
            "year_month",
            F.round("inflation_12m", digits).cast(t).alias("inflation_12m"),
            F.col("reference").cast(t).alias("reference"),
            (F.round("inflation_12m", digits) - F.col("reference")).cast(t).alias("difference"),
            F.round("policy_12m", digits).cast(t).alias("policy_12m"),
            F.round("real_12m", digits).cast(t).alias("real_12m"),
        )
        .orderBy("year_month")
    )


def validate_official(spark: SparkSession, gold: DataFrame) -> DataFrame:
    """Decembers of the published series vs the official yearly inflation."""
    return external_validation(gold, official_reference(spark))


def check_report(results: DataFrame) -> DataFrame:
    """All check results with a status word, layer order kept."""
    order = F.when(F.col("layer") == "bronze", 0).when(F.col("layer") == "silver", 1).otherwise(2)
    return results.select(
        "layer",
        "name",
        F.when(F.col("passed"), F.lit("PASSED")).otherwise(F.lit("FAILED")).alias("status"),
        "expected",
        "observed",
        "description",
    ).orderBy(order, "name")

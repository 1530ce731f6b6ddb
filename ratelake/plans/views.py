"""SQL surface: the layer tables and the evidence reports as temp views.

With ``Settings.database`` the layer tables are also named in the catalog, so
any session that shares it can ``SELECT * FROM <database>.gold``.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake.plans import reports
from ratelake.plans.runner import gold_table, silver_table, stored_results
from ratelake.settings import Settings
from ratelake.streaming.ingest import bronze_exists, read_bronze


def register_views(spark: SparkSession, settings: Settings, prefix: str = "") -> list[str]:
    """``bronze``, ``silver``, ``gold`` and the histories of the two upserted tables."""
    found: dict[str, DataFrame] = {}
    if bronze_exists(spark, settings.bronze_path):
        found["bronze"] = read_bronze(spark, settings.bronze_path)
    for label, t in (("silver", silver_table(spark, settings)), ("gold", gold_table(spark, settings))):
        if t.exists():
            found |= {label: t.read(), f"{label}_history": t.history()}
    for label, df in found.items():
        df.createOrReplaceTempView(prefix + label)
    return [prefix + label for label in found]


def evidence(spark: SparkSession, settings: Settings) -> dict[str, DataFrame]:
    """Every report over the stored tables, by name."""
    bronze = read_bronze(spark, settings.bronze_path)
    silver_t = silver_table(spark, settings)
    silver, gold = silver_t.read(), gold_table(spark, settings).read()
    counters = [F.col("metrics")[k].cast("bigint").alias(k) for k in ("rows_inserted", "rows_updated", "rows_deleted")]
    return {
        "checks": reports.check_report(stored_results(spark, settings)),
        "volumes": reports.layer_volumes(bronze, silver, gold),
        "batches": reports.ingest_batches(bronze),
        "upserts": silver_t.history().select("version", "written_at", "operation", *counters),
        "grain": reports.grain_report(silver, gold),
        "official": reports.validate_official(spark, gold),
        "decembers": reports.december_view(gold),
        "bronze_files": reports.bronze_profile(bronze),
        "silver_series": reports.silver_profile(silver),
    }


def register_evidence(spark: SparkSession, settings: Settings, prefix: str = "evidence_") -> list[str]:
    """The reports as temp views, for SQL users."""
    found = evidence(spark, settings)
    for name, df in found.items():
        df.createOrReplaceTempView(prefix + name)
    return [prefix + name for name in found]


def scalar(spark: SparkSession, query: str) -> Any:
    """First column of the first row of ``query``, or None when it is empty."""
    row = spark.sql(query).first()
    return None if row is None else row[0]

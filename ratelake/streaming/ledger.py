"""What Bronze holds of each landing file, kept up by a stream.

The ledger has one row per landing file and ingest batch, written when the
batch is, so rules on Bronze, counts of rejected rows and the search for lost
or changed files read some rows per file instead of all of Bronze. Each
micro-batch writes a folder named by its number, so a batch that is run again
replaces its own rows. (Counts by ``DataFrame.observe`` would be lost with the
driver and count a stage twice that lost executors made run again.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake.functions.series import with_series
from ratelake.operators.conform import rejected_predicate
from ratelake.schemas import BRONZE, LEDGER
from ratelake.session import path_exists
from ratelake.settings import Settings
from ratelake.sources.landing import files_in, list_files


def file_counts(bronze: DataFrame, settings: Settings) -> DataFrame:
    """The ledger's rows for Bronze rows: a partial aggregation per file, so a large file is no hot key."""
    raw = F.col("date_raw").isNull() & F.col("value_raw").isNull()
    provenance = F.col("source_file").isNull() | F.col("ingested_at").isNull()
    counts = bronze.groupBy("source_file").agg(
        F.max("file_modified_at").alias("file_modified_at"),
        F.max("ingested_at").alias("ingested_at"),
        F.count(F.lit(1)).alias("rows"),
        F.count_if(provenance).alias("no_provenance"),
        F.count_if(raw).alias("no_raw_field"),
        F.count_if(rejected_predicate(settings.raw_date_format, settings.value_type)).alias("rejected"),
    )
    return with_series(counts, settings.series, ("series_id", "name")).withColumnRenamed("name", "series_name")


def read_ledger(spark: SparkSession, settings: Settings) -> DataFrame:
    if not path_exists(spark, settings.ledger_path):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(settings.ledger_path)


def stream_bronze(spark: SparkSession, settings: Settings) -> DataFrame:
    """Bronze as a stream: what the landing stream wrote and what was read again because it changed."""
    reader = spark.readStream.schema(BRONZE).option("maxFileAge", settings.max_file_age)
    if settings.max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", settings.max_files_per_trigger)
    resent = spark.readStream.schema(BRONZE).option("maxFileAge", settings.max_file_age).option("recursiveFileLookup", "true")
    return reader.parquet(settings.bronze_path).unionByName(resent.parquet(settings.resent_path))


def update_ledger(spark: SparkSession, settings: Settings) -> DataFrame:
    """Take the new Bronze rows into the ledger; returns it."""

    def add(batch: DataFrame, batch_id: int) -> None:
        file_counts(batch, settings).coalesce(1).write.mode("overwrite").parquet(f"{settings.ledger_path}/batch={batch_id}")

    writer = stream_bronze(spark, settings).writeStream.foreachBatch(add)
    writer.option("checkpointLocation", f"{settings.checkpoints}/bronze_files").trigger(availableNow=True).start().awaitTermination()
    return read_ledger(spark, settings)


def lost_files(landed: DataFrame, ledger: DataFrame) -> DataFrame:
    """Landed files of which Bronze has no row."""
    return landed.join(ledger.select("source_file").distinct(), "source_file", "left_anti")


def changed_files(landed: DataFrame, ledger: DataFrame) -> DataFrame:
    """Landed files that changed, under their old name, after Bronze took them."""
    taken = ledger.groupBy("source_file").agg(F.max("file_modified_at").alias("taken_at"))
    return landed.join(taken, "source_file").where(F.col("file_modified_at") > F.col("taken_at")).drop("taken_at")


def landed_files(spark: SparkSession, settings: Settings) -> DataFrame:
    """Files in the landing folder; with an archive these are the ones not moved yet."""
    if settings.archive and not files_in(spark, settings.landing, settings.file_glob):
        return spark.createDataFrame([], "source_file string, file_modified_at timestamp, bytes bigint")
    return list_files(spark, settings.landing, settings.file_glob)

"""Incremental ingest of landing files into Bronze (Structured Streaming).

``trigger(availableNow=True)`` drains every pending file in bounded
micro-batches and stops, which suits a scheduled job. The file source's
checkpoint records which files were read, so a rerun reads nothing twice; the
Parquet sink's ``_spark_metadata`` log makes each batch's output visible
exactly once (readers of the folder only see committed files), so a batch
retried after an executor loss does not duplicate rows.

``incremental_silver`` reads Bronze as a stream and upserts each micro-batch
through ``foreachBatch``. A batch that the table's audit already holds is
skipped; one that was written but not recorded is merged again, which changes
nothing.

The file stream never reads a path twice. A file that was sent again under its
old name is found by its modification time (see ``ledger``) and read by batch
into a folder beside Bronze, which every reader of Bronze reads along.
"""

from __future__ import annotations

import logging
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake.operators.conform import conform
from ratelake.operators.month_state import month_state
from ratelake.schemas import BRONZE, MONTH_STATE, SILVER, SILVER_KEY, SILVER_LAYOUT, SILVER_TEXT
from ratelake.session import make_folder, path_exists, written_once
from ratelake.settings import Settings
from ratelake.sources.landing import files_in, read_files, stream_landing
from ratelake.sources.tables import StoredTable
from ratelake.streaming.ledger import changed_files, landed_files, stream_bronze, update_ledger

LOGGER = logging.getLogger("ratelake.ingest")

# An update "changes" a row only when one of these differs (a re-sent file
# refreshes ingest time and provenance, and is counted as updated, not changed).
SILVER_COMPARE = ("series_name", "granularity", "value")


def silver_table(spark: SparkSession, s: Settings) -> StoredTable:
    name = f"{s.database}.silver" if s.database else None
    layout = {c: e.format(buckets=s.silver_buckets) for c, e in SILVER_LAYOUT.items()}
    return StoredTable(
        spark, s.silver_path, SILVER, layout, name, SILVER_TEXT,
        summary=lambda rows: month_state(rows, s.series, list(layout)), summary_schema=MONTH_STATE,
    )


def bronze_exists(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path.rstrip('/')}/_spark_metadata")


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the landing stream and of the files read again (``<path>_resent``)."""
    rows, resent = spark.read.schema(BRONZE).parquet(path), f"{path.rstrip('/')}_resent"
    if not path_exists(spark, resent):
        return rows
    return rows.unionByName(spark.read.schema(BRONZE).option("recursiveFileLookup", "true").parquet(resent))


def count_rows(spark: SparkSession, path: str) -> int:
    return read_bronze(spark, path).count() if bronze_exists(spark, path) else 0


def ingest(spark: SparkSession, settings: Settings, *, max_files_per_trigger: int | None = None) -> dict:
    """Append every pending landing file to Bronze; return run counters.

    The totals are counted from the file footers before and after, whatever
    the number of micro-batches; the rows of this run are their difference.
    """
    make_folder(spark, settings.resent_path)
    before = count_rows(spark, settings.bronze_path)
    stream = stream_landing(
        spark,
        settings.landing,
        settings.file_glob,
        multi_line=settings.multi_line,
        max_files_per_trigger=max_files_per_trigger or settings.max_files_per_trigger,
        max_file_age=settings.max_file_age,
        archive=settings.archive,
    )
    writer = stream.writeStream.format("parquet").option("path", settings.bronze_path)
    writer = writer.option("checkpointLocation", settings.bronze_checkpoint).outputMode("append")
    writer.trigger(availableNow=True).start().awaitTermination()
    waiting = files_in(spark, settings.landing, settings.file_glob)
    archived = files_in(spark, settings.archive, settings.file_glob) if settings.archive else 0
    if archived or waiting:
        ledger = update_ledger(spark, settings)
    changed = ingest_changed(spark, settings, ledger) if waiting else 0
    after = count_rows(spark, settings.bronze_path)
    metrics = {
        "table": settings.bronze_path,
        "rows_before": before,
        "rows_after": after,
        "rows_ingested": after - before,
        "files_changed": changed,
        "landing_files": waiting + archived,
    }
    LOGGER.info("Bronze: %s", metrics)
    return metrics


def ingest_changed(spark: SparkSession, settings: Settings, ledger: DataFrame) -> int:
    """Read landing files again that changed under their old name; how many there were.

    Their rows carry the new modification time and this run's time, so they win
    over the old ones in Silver; Bronze keeps both. A run that died after the
    rows were written reads them once more, which changes nothing in Silver.
    """
    paths = [r.source_file for r in changed_files(landed_files(spark, settings), ledger).select("source_file").collect()]
    if paths:
        rows = read_files(spark, paths, multi_line=settings.multi_line)
        rows.write.mode("append").parquet(settings.resent_path)
        update_ledger(spark, settings)
        LOGGER.info("%d landing files changed and were read again", len(paths))
    return len(paths)


def incremental_silver(spark: SparkSession, settings: Settings, checkpoint: str | None = None) -> dict:
    """Stream Bronze -> conform -> upsert into Silver; counters summed over the batches.

    The audit records ``(stream, batch_id)``, the stream being its checkpoint
    location: batch ids restart at 0 under a new checkpoint, so the id alone
    would not identify a replay. Each batch is conformed once, to a staged table.
    """
    table = silver_table(spark, settings)
    stream = checkpoint or f"{settings.checkpoints}/silver"
    sums: Counter = Counter()

    def upsert_batch(batch: DataFrame, batch_id: int) -> None:
        m = F.col("metrics")
        if not table.audit().where((m["batch_id"] == str(batch_id)) & (m["stream"] == stream)).isEmpty():
            LOGGER.info("batch %s is in the audit already; skipped", batch_id)
            return
        source = conform(batch, settings.series, date_format=settings.raw_date_format, value_type=settings.value_type)
        with written_once(source, "silver-batch") as source:
            got = table.merge(
                source, SILVER_KEY, "ingested_at", compare=SILVER_COMPARE,
                check_unique=False,  # conform() keeps one row per key
                extra={"batch_id": batch_id, "stream": stream},
            )
        sums.update({k: v for k, v in got.items() if k in ("rows_inserted", "rows_updated", "rows_changed", "rows_matched_noop")})
        sums["batches"] += 1

    make_folder(spark, settings.resent_path)
    writer = stream_bronze(spark, settings).writeStream.foreachBatch(upsert_batch)
    writer.option("checkpointLocation", stream).trigger(availableNow=True).start().awaitTermination()
    names = ("batches", "rows_inserted", "rows_updated", "rows_changed", "rows_matched_noop")
    return {**{k: sums[k] for k in names}, "rows_deleted": 0, "rows_total": table.count()}

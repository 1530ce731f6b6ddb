"""The layered run: ingest -> gate -> upsert -> gate -> rebuild -> gate.

Layers pass data only through stored tables, so each step reads stored data
and a failed step can be rerun alone. The run stops at the first failed gate
unless ``stop_on_failure`` is off; then it goes on and the full report is
returned, except that with ``gate_mode="before_commit"`` nothing refused is
stored and Gold isn't rebuilt over a Silver that was refused.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake.operators.conform import conform
from ratelake.operators.month_state import month_state, monthly_rates_of_state
from ratelake.operators.quality import RESULT_SCHEMA, DataQualityError, gate
from ratelake.plans.checks import bronze_results, fresh_state, gold_results, ledger_results, silver_results, state_results
from ratelake.plans.gold import build_gold, consolidated, refreshed_gold
from ratelake.schemas import GOLD, GOLD_TEXT, SILVER_KEY
from ratelake.session import _context, written_once
from ratelake.settings import Settings
from ratelake.sources.tables import StoredTable, sql_text
from ratelake.streaming.ingest import SILVER_COMPARE, incremental_silver, ingest, read_bronze, silver_table
from ratelake.streaming.ledger import read_ledger

LOGGER = logging.getLogger("ratelake.run")


def gold_table(spark: SparkSession, s: Settings) -> StoredTable:
    return StoredTable(spark, s.gold_path, GOLD, None, f"{s.database}.gold" if s.database else None, GOLD_TEXT, versioned=True)


@dataclass
class RunReport:
    metrics: dict = field(default_factory=dict)
    results: list = field(default_factory=list)  # result rows of all layers

    @property
    def passed(self) -> bool:
        return all(r.passed for r in self.results)

    def to_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.results, RESULT_SCHEMA)

    def check(self, results: DataFrame, layer: str, stop: bool) -> bool:
        got = results.collect()
        self.results.extend(got)
        try:
            gate(got, layer)
        except DataQualityError:
            if stop:
                raise
            return False
        return True


def ensure_layout(spark: SparkSession, settings: Settings) -> None:
    """Create the landing, checkpoint and table folders (idempotent) and the catalog schema, if named."""
    if settings.database:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {settings.database} LOCATION " + sql_text(f"{settings.root.rstrip('/')}/catalog"))
    sc = _context(spark)
    if sc is None:  # Spark Connect: folders are created by the first write
        return
    jvm = sc._jvm
    conf = sc._jsc.hadoopConfiguration()
    for p in (settings.landing, settings.checkpoints, f"{settings.root.rstrip('/')}/tables"):
        hp = jvm.org.apache.hadoop.fs.Path(p)
        hp.getFileSystem(conf).mkdirs(hp)


def run_bronze(spark: SparkSession, s: Settings, report: RunReport, stop: bool) -> DataFrame:
    """Ingest and check; returns the file ledger, from which the rules read."""
    report.metrics["bronze"] = ingest(spark, s)
    ledger = read_ledger(spark, s)
    report.check(ledger_results(ledger, s, report.metrics["bronze"]["landing_files"]), "bronze", stop)
    return ledger


def run_silver(spark: SparkSession, s: Settings, ledger: DataFrame, report: RunReport, stop: bool) -> bool:
    """Upsert Bronze into Silver and check it; False if what would be stored was refused.

    The rules on the stored table read its month state. With
    ``gate_mode="before_commit"`` they look at rows that are not stored yet, so
    these are summed up for it.
    """
    table = silver_table(spark, s)
    before = table.count()
    stored = True
    if s.silver_mode == "incremental":
        m = incremental_silver(spark, s)
    else:
        # staged, as the upsert reads it more than once
        bronze = read_bronze(spark, s.bronze_path)
        source = conform(bronze, s.series, date_format=s.raw_date_format, value_type=s.value_type)
        first = s.gate_mode == "before_commit"
        accept = (lambda rows: report.check(state_results(month_state(rows, s.series), s, ledger), "silver", stop)) if first else None
        with written_once(source, "silver-staging") as source:
            m = table.merge(source, SILVER_KEY, "ingested_at", compare=SILVER_COMPARE, check_unique=False, accept=accept)
        stored = m.pop("committed")
    report.metrics["silver"] = {"rows_before": before, "rows_after": m["rows_total"], "rows_new": m["rows_total"] - before, **m}
    if s.gate_mode == "after_commit":
        report.check(state_results(fresh_state(table, s), s, ledger), "silver", stop)
    return stored


def silver_changes(spark: SparkSession, s: Settings) -> tuple[int, str | None, str | None]:
    """Audit rows of Silver, and the first and last month that merges changed since Gold was published."""
    m = F.col("metrics")
    seen = gold_table(spark, s).audit().agg(F.max(m["silver_writes"].cast("bigint"))).first()[0] or 0
    new = silver_table(spark, s).history().select("version", m["first_period"].alias("first"), m["last_period"].alias("last"))
    total, first, last = new.agg(
        F.count(F.lit(1)), F.min(F.when(F.col("version") >= seen, F.col("first"))), F.max(F.when(F.col("version") >= seen, F.col("last")))
    ).first()
    return total, first, last


def gold_definition(s: Settings) -> str:
    """What makes Gold another table over the same Silver: rows of another definition are not taken over."""
    return f"{s.policy_series} {s.inflation_series} {s.value_type} {s.rolling_months} {s.rolling_gate} {s.rolling_frame}"


def run_gold(spark: SparkSession, s: Settings, report: RunReport, stop: bool) -> None:
    """Bring Gold up to the stored Silver and check it.

    A table of the same definition is refreshed for the months that changed; if
    none did, nothing is written.
    """
    table, silver = gold_table(spark, s), silver_table(spark, s)
    writes, first, last = silver_changes(spark, s)
    written_as = table.audit().agg(F.max_by(F.col("metrics")["definition"], "written_at")).first()[0]
    same = table.exists() and written_as == gold_definition(s)
    accept = (lambda rows: report.check(gold_results(rows, s), "gold", stop)) if s.gate_mode == "before_commit" else None
    if s.gold_mode == "rebuild":
        rebuilt = build_gold(silver.read(), s)
    elif same:
        rebuilt = refreshed_gold(table.read(), fresh_state(silver, s), s, first, last) if first else None
    else:
        rates = monthly_rates_of_state(fresh_state(silver, s), s.policy_series, s.inflation_series, s.value_type)
        rebuilt = consolidated(rates, s)
    if rebuilt is None:
        m = {"rows_total": table.count(), "committed": False}
        if accept:
            accept(table.read())
    else:
        # one small file in order: a row a month
        rebuilt = rebuilt.repartition(1).sortWithinPartitions("year_month")
        m = table.overwrite(rebuilt, accept=accept, extra={"silver_writes": writes, "definition": gold_definition(s)})
    report.metrics["gold"] = {"rows": m["rows_total"], "committed": m["committed"]}
    if s.gate_mode == "after_commit":
        report.check(gold_results(table.read(), s), "gold", stop)


def run(spark: SparkSession, settings: Settings, *, stop_on_failure: bool = True) -> RunReport:
    """The whole layered run over ``settings.root``."""
    report = RunReport()
    ensure_layout(spark, settings)
    ledger = run_bronze(spark, settings, report, stop_on_failure)
    if run_silver(spark, settings, ledger, report, stop_on_failure):
        run_gold(spark, settings, report, stop_on_failure)
    else:
        LOGGER.error("Silver was refused: Gold stays as it is")
        report.metrics["gold"] = {"rows": gold_table(spark, settings).count(), "committed": False}
    LOGGER.info("run finished: %s", report.metrics)
    return report


def stored_results(spark: SparkSession, settings: Settings) -> DataFrame:
    """The check report of the stored tables, without a run: all rows are counted anew."""
    bronze = read_bronze(spark, settings.bronze_path)
    out = bronze_results(bronze, settings)
    out = out.unionByName(silver_results(silver_table(spark, settings).read(), settings, bronze))
    return out.unionByName(gold_results(gold_table(spark, settings).read(), settings))


def backfill(
    spark: SparkSession, settings: Settings, first_month: str, last_month: str | None = None, **kw
) -> RunReport:
    """Same run with a wider window: new landing files are ingested, the upsert
    absorbs overlaps without duplicates, Gold is rebuilt over the whole span."""
    wider = settings.with_(first_month=first_month, last_month=last_month or settings.last_month)
    return run(spark, wider, **kw)


__all__ = ["RunReport", "run", "backfill", "stored_results", "ensure_layout", "gold_table", "silver_table"]

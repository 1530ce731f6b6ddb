"""The rules of the three layers, built from the generic kinds and the settings.

Each layer's rules come twice, with the same names, targets and results: over
the rows of a table (any DataFrame), and over what a run keeps up beside the
tables (the file ledger for Bronze, the month state for Silver), whose cost
follows the number of files and months, not that of the rows.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelake.functions.series import series_of
from ratelake.operators.conform import rejection_counts
from ratelake.operators.month_state import REQUIRED as SILVER_REQUIRED
from ratelake.operators.month_state import domain_digest
from ratelake.operators.quality import Rule, dense, evaluate, given, in_range, never, not_null, periods, rows, unique
from ratelake.schemas import SILVER, SILVER_KEY
from ratelake.settings import Settings
from ratelake.sources.landing import files_in, missing_files
from ratelake.streaming.ledger import changed_files, landed_files, lost_files

GOLD_REQUIRED = ("policy_mean_day", "policy_month", "inflation_month", "real_month")


def bronze_rules(settings: Settings) -> list[Rule]:
    name = series_of("source_file", settings.series)["name"]
    return [
        rows(1, ">="),
        not_null("source_file", "ingested_at"),
        Rule("series_present", F.count_distinct(name), len(settings.series), meaning="series with a row"),
        never("no raw field", F.col("date_raw").isNull() & F.col("value_raw").isNull()),
    ]


def landing_rules(bronze: DataFrame, settings: Settings, n: int | None = None) -> list[Rule]:
    """Rules on the landing folder: there are files (``n``, if counted already),
    Bronze has rows of every one, and none changed after Bronze took it.

    A folder that doesn't exist holds no files; nothing can be missing then.
    """
    spark = bronze.sparkSession
    n = files_in(spark, settings.landing, settings.file_glob) if n is None else n
    lost = changed = F.lit(0)
    if n:
        lost = missing_files(spark, settings.landing, bronze, settings.file_glob).agg(F.count(F.lit(1))).scalar()
        changed = changed_files(landed_files(spark, settings), bronze).agg(F.count(F.lit(1))).scalar()
    return [
        given("landing_files", F.lit(n), 1, ">="),
        given("landing_files_without_rows", lost, 0),
        given("landing_files_changed", changed, 0),
    ]


def bronze_results(bronze: DataFrame, settings: Settings, landing: bool = True, landing_files: int | None = None) -> DataFrame:
    own = landing_rules(bronze, settings, landing_files) if landing else []
    return evaluate(bronze, own + bronze_rules(settings), "bronze")


def _sum(c, where=None) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.sum(c if where is None else F.when(where, c)), F.lit(0))


def ledger_results(ledger: DataFrame, settings: Settings, landing_files: int | None) -> DataFrame:
    """The Bronze rules from the file ledger, and (with a number of landed files) whether any are lost or changed."""
    rules = []
    if landing_files is not None:
        lost = changed = F.lit(0)
        if landing_files:
            landed = landed_files(ledger.sparkSession, settings)
            lost, changed = (f(landed, ledger).agg(F.count(F.lit(1))).scalar() for f in (lost_files, changed_files))
        rules = [
            given("landing_files", F.lit(landing_files), 1, ">="),
            given("landing_files_without_rows", lost, 0),
            given("landing_files_changed", changed, 0),
        ]
    measures = (_sum("rows"), _sum("no_provenance"), F.count_distinct("series_name"), _sum("no_raw_field"))
    rules += [dataclasses.replace(r, measure=m) for r, m in zip(bronze_rules(settings), measures)]
    return evaluate(ledger, rules, "bronze")


def state_results(state: DataFrame, settings: Settings, ledger: DataFrame | None = None) -> DataFrame:
    """The Silver rules from the month state; those on dropped rows from the ledger."""
    series, month = F.col("series_name"), F.col("year_month")
    infl, pol = series == settings.inflation_series, series == settings.policy_series
    outside = (month < settings.first_month) | (month > settings.last_month)
    thin = pol & (F.col("rows") < settings.min_policy_days_per_month)
    measures = [
        _sum(F.col("rows") - F.col("keys")),
        _sum("nulls"),
        *[_sum("out_of_domain", series == s.name) for s in settings.series],
        _sum("rows", outside),
        F.count_distinct(F.when(infl, month)),
        _sum("not_day_1", infl),
        F.count_if(thin),
        _sum("not_above_minus_100"),
    ]
    # a NULL day makes no difference to the names: the rules are built over an empty table
    named = silver_rules(state.sparkSession.createDataFrame([], SILVER), settings)
    rules = [dataclasses.replace(r, measure=m, scalar=False) for r, m in zip(named, measures, strict=True)]
    if ledger is not None:
        dropped = ledger.agg(_sum("rejected").alias("rejected_rows"), _sum("rows", F.col("series_id").isNull()).alias("unmapped_rows"))
        rules += [given(c, dropped.select(c).scalar(), 0) for c in ("rejected_rows", "unmapped_rows")]
    return evaluate(state, rules, "silver")


def fresh_state(table, settings: Settings) -> DataFrame:
    """The table's month state, recounted first if there is none or its value domains are others."""
    state = table.state()
    if state is None or not state.where(F.col("domain_digest") != domain_digest(settings.series)).isEmpty():
        table.recount()
        state = table.state()
    return state


def silver_rules(silver: DataFrame, settings: Settings, bronze: DataFrame | None = None) -> list[Rule]:
    """Rules on what Silver dropped need Bronze; without it they are not in the list."""
    series = F.col("series_name")
    infl, pol = series == settings.inflation_series, series == settings.policy_series
    out = [
        unique(silver, SILVER_KEY),
        not_null(*SILVER_REQUIRED),
        *[in_range("value", *s.domain, series == s.name, f"{s.name} value") for s in settings.series],
        in_range("ref_date", settings.first_date, settings.last_date),
        periods(settings.inflation_series, infl, "year_month", settings.expected_months),
        never(f"{settings.inflation_series} not on day 1", infl & (F.dayofmonth("ref_date") != 1)),
        dense(silver, settings.policy_series, pol, "year_month", settings.min_policy_days_per_month),
        never("rate at or below -100 %", F.col("value") <= -100),
    ]
    if bronze is not None:
        counts = rejection_counts(bronze, settings.series, date_format=settings.raw_date_format, value_type=settings.value_type)
        out += [given(c, counts.select(c).scalar(), 0) for c in ("rejected_rows", "unmapped_rows")]
    return out


def silver_results(silver: DataFrame, settings: Settings, bronze: DataFrame | None = None) -> DataFrame:
    return evaluate(silver, silver_rules(silver, settings, bronze), "silver")


def gold_rules(gold: DataFrame, settings: Settings) -> list[Rule]:
    one = lambda c: 1 + F.col(c) / 100
    gap = F.abs(one("real_month") * one("inflation_month") - one("policy_month"))
    n = settings.expected_months
    return [
        unique(gold, ["year_month"]),
        rows(n),
        not_null(*GOLD_REQUIRED),
        Rule("rolling_complete", F.count("real_12m"), n - settings.rolling_months + 1, meaning="months with a full window"),
        never("real x inflation differs from policy", gap > settings.fisher_tolerance),
        never(f"fewer than {settings.min_policy_days_per_month} policy days", F.col("policy_days") < settings.min_policy_days_per_month),
    ]


def gold_results(gold: DataFrame, settings: Settings) -> DataFrame:
    return evaluate(gold, gold_rules(gold, settings), "gold")

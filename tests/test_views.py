"""SQL surface over a finished run: views, scalar helper, comments, history."""

import pytest

from helpers import series_payload, settings_for, write_json
from ratelake.operators.quality import DataQualityError
from ratelake.plans.runner import gold_table, run, silver_table
from ratelake.plans.views import register_evidence, register_views, scalar
from ratelake.schemas import COLUMN_TEXTS, SILVER_TEXT


def _land(st):
    sel, ipc = series_payload(months=24, days=20)
    write_json(f"{st.landing}/selic.json", sel)
    write_json(f"{st.landing}/ipca.json", ipc)
    return len(sel) + len(ipc)


def test_views_scalar_comments(spark, root):
    st = settings_for(root)
    n = _land(st)
    assert run(spark, st).passed
    names = register_views(spark, st, prefix="t_")
    assert {"t_bronze", "t_silver", "t_gold", "t_silver_history"} <= set(names)
    assert scalar(spark, "SELECT COUNT(*) FROM t_silver") == n
    assert scalar(spark, "SELECT COUNT(*) FROM t_gold WHERE year_month LIKE '%-12'") == 2
    assert scalar(spark, "SELECT SUM(CAST(metrics['rows_inserted'] AS BIGINT)) FROM t_silver_history") == n
    assert scalar(spark, "SELECT year_month FROM t_gold WHERE FALSE") is None


def test_named_tables_keep_up_with_the_runs(spark, root):
    st = settings_for(root, database="rates_test")
    n = _land(st)
    assert run(spark, st).passed
    assert spark.table("rates_test.silver").count() == n and spark.table("rates_test.gold").count() == 24
    described = {r.col_name: r for r in spark.sql("DESCRIBE TABLE EXTENDED rates_test.silver").collect()}
    assert described["Comment"].data_type == SILVER_TEXT and described["value"].comment == COLUMN_TEXTS["value"]
    sel, ipc = series_payload(months=1, days=20, start=(2022, 1))
    write_json(f"{st.landing}/selic_2022.json", sel)
    write_json(f"{st.landing}/ipca_2022.json", ipc)
    assert run(spark, st.with_(last_month="2022-01")).passed
    assert spark.table("rates_test.silver").count() == n + 21  # new partitions are known
    for t in ("silver", "gold"):
        spark.sql(f"DROP TABLE rates_test.{t}")


def test_incremental_silver_mode_matches_batch(spark, tmp_path):
    a = settings_for(str(tmp_path / "a"), silver_mode="batch")
    b = settings_for(str(tmp_path / "b"), silver_mode="incremental")
    _land(a)
    _land(b)
    ra, rb = run(spark, a), run(spark, b)
    assert ra.passed and rb.passed
    cols = ["series_id", "ref_date", "value", "year_month"]
    sa = silver_table(spark, a).read().select(cols)
    sb = silver_table(spark, b).read().select(cols)
    assert sa.exceptAll(sb).count() == 0 and sb.exceptAll(sa).count() == 0
    ga = gold_table(spark, a).read().drop("processed_at")
    gb = gold_table(spark, b).read().drop("processed_at")
    assert ga.exceptAll(gb).count() == 0
    rb2 = run(spark, b)
    assert rb2.metrics["silver"]["rows_inserted"] == 0 and rb2.metrics["silver"]["rows_total"] == sa.count()


def test_before_commit_stores_nothing_refused(spark, root):
    st = settings_for(root, gate_mode="before_commit", silver_mode="batch")
    n = _land(st)
    assert run(spark, st).passed
    # a resent file that moves a value out of its domain
    sel, _ = series_payload(months=1, days=1, daily="5.0")
    write_json(f"{st.landing}/selic_2020.json", sel)
    gold = gold_table(spark, st)
    written = gold.history().count()
    with pytest.raises(DataQualityError, match="selic value in"):
        run(spark, st)
    # without stopping, Gold isn't rebuilt over the refused Silver either
    report = run(spark, st, stop_on_failure=False)
    assert not report.passed and report.metrics["gold"]["committed"] is False
    silver = silver_table(spark, st).read()
    assert silver.count() == n and silver.filter("value > 1").count() == 0
    assert gold.history().count() == written and gold.read().count() == 24


def test_before_commit_needs_batch_mode(root):
    with pytest.raises(ValueError, match="before_commit"):
        settings_for(root, gate_mode="before_commit")


def test_official_validation_join(spark):
    from decimal import Decimal

    from ratelake.plans.reports import validate_official

    gold = spark.createDataFrame(
        [("2020-12", Decimal("4.52123456"), Decimal("2.76"), Decimal("-1.68")), ("2020-11", None, None, None)],
        "year_month string, inflation_12m decimal(18,8), policy_12m decimal(18,8), real_12m decimal(18,8)",
    )
    rows = validate_official(spark, gold).collect()
    assert len(rows) == 1 and rows[0].reference == Decimal("4.52") and rows[0].difference == Decimal("0.00")


def test_evidence_reports_as_views(spark, root):
    st = settings_for(root, months=24)
    n = _land(st)
    assert run(spark, st).passed
    names = register_evidence(spark, st)
    assert len(names) == 9
    assert scalar(spark, "SELECT COUNT(*) FROM evidence_checks WHERE status <> 'PASSED'") == 0
    assert scalar(spark, "SELECT SUM(rows_inserted) FROM evidence_upserts") == n
    assert scalar(spark, "SELECT rows FROM evidence_volumes WHERE layer = 'silver'") == n
    assert scalar(spark, "SELECT MAX(ingest_batches) FROM evidence_batches") == 1
    assert scalar(spark, "SELECT COUNT(*) FROM evidence_official") == 2
    assert scalar(spark, "SELECT COUNT(*) FROM evidence_grain WHERE rows = distinct_keys") == 2
    assert scalar(spark, "SELECT COUNT(*) FROM evidence_decembers WHERE real_12m IS NOT NULL") == 2


def test_command_line_run_and_report(spark, root, capsys):
    from ratelake.__main__ import main

    st = settings_for(root)
    _land(st)
    args = ["--root", root, "--first-month", st.first_month, "--last-month", st.last_month]
    assert main(["run", *args], spark=spark) == 0
    assert '"rows_ingested"' in capsys.readouterr().out
    assert main(["report", *args], spark=spark) == 0
    assert "== checks" in capsys.readouterr().out
    # a window that does not match the data fails the gate -> exit code 1
    assert main(["run", "--root", root, "--first-month", "2019-01", "--last-month", "2021-12"], spark=spark) == 1

"""Landing files, streaming ingest (once per file) and the layered run."""

import hashlib
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from helpers import series_payload, settings_for, write_json
from ratelake.operators.quality import DataQualityError
from ratelake.plans.runner import run
from ratelake.sources.landing import files_in, manifest, missing_files, payload_contract, read_landing
from ratelake.streaming.ingest import incremental_silver, ingest, read_bronze, silver_table


def _land(st, months=24, days=20, **kw):
    sel, ipc = series_payload(months=months, days=days, **kw)
    write_json(f"{st.landing}/selic.json", sel)
    write_json(f"{st.landing}/ipca.json", ipc)
    write_json(f"{st.landing}/_manifest.json", [{"serie": "selic"}])
    return len(sel) + len(ipc)


def test_pretty_array_read_with_provenance(spark, root):
    st = settings_for(root)
    n = _land(st)
    df = read_landing(spark, st.landing)
    assert df.count() == n  # _manifest.json is hidden (leading underscore)
    r = df.filter("source_file LIKE '%ipca.json'").orderBy("date_raw").first()
    assert r.date_raw == "01/01/2020" and r.value_raw == "0.40" and r.file_modified_at is not None


def test_bad_files_and_contract(spark, root):
    land = f"{root}/landing"
    write_json(f"{land}/good.json", [{"data": "01/01/2020", "valor": "0.1"}, {"data": "02/01/2020", "valor": 0.10}])
    write_json(f"{land}/empty.json", [])
    write_json(f"{land}/html.json", "<html>x</html>")
    write_json(f"{land}/nofield.json", [{"data": "01/01/2020"}])
    write_json(f"{land}/object.json", {"data": "01/01/2020", "valor": "0.1"})
    rows = {r.source_file.rsplit("/", 1)[1]: r for r in payload_contract(spark, land).collect()}
    assert rows["good.json"].passed and rows["good.json"].records == 2
    assert not rows["empty.json"].passed and rows["empty.json"].failure == "empty list"
    assert not rows["html.json"].passed and rows["html.json"].failure == "not valid JSON"
    assert not rows["nofield.json"].passed and rows["nofield.json"].failure == "records lack data/valor"
    assert not rows["object.json"].passed and rows["object.json"].failure == "not a list"
    vals = sorted(r.value_raw for r in read_landing(spark, f"{land}/good.json").collect())
    assert vals == ["0.1", "0.1"]  # numeric 0.10 arrives as text '0.1'


def test_manifest(spark, root):
    st = settings_for(root)
    _land(st)
    m = {r.series_name: r for r in manifest(spark, st.landing, st.series).collect()}
    assert m["selic"].rows == 480 and m["ipca"].rows == 24
    assert str(m["ipca"].first_date) == "2020-01-01" and str(m["ipca"].last_date) == "2021-12-01"
    assert m["selic"].series_id == 11 and m["ipca"].unit == "% a.m."
    for name in ("selic", "ipca"):
        with open(f"{st.landing}/{name}.json", "rb") as f:
            assert m[name].sha256 == hashlib.sha256(f.read()).hexdigest()


def test_names_that_need_encoding_and_long_leading_blanks(spark, root):
    land = f"{root}/landing"
    record = [{"data": "01/01/2020", "valor": "0.1"}]
    names = ["with space.json", "pct%41.json", "a+b.json", "ü.json", "selic 2020.json"]
    for name in names:
        write_json(f"{land}/{name}", record)
    write_json(f"{land}/blank.json", " " * 70_000 + "\n\t" * 40_000 + '[{"data": "01/01/2020", "valor": "1"}]')
    got = {r.source_file.rsplit("/", 1)[1]: r for r in payload_contract(spark, land).collect()}
    assert set(got) == {*names, "blank.json"} and all(r.passed and r.records == 1 for r in got.values())
    listed = {r.source_file.rsplit("/", 1)[1]: r["rows"] for r in manifest(spark, land, settings_for(root).series).collect()}
    assert listed == dict.fromkeys(got, 1)


def test_late_file_is_ingested_and_nothing_is_missing(spark, root):
    st = settings_for(root)
    sel, ipc = series_payload(months=24)
    write_json(f"{st.landing}/selic.json", sel)
    assert ingest(spark, st)["rows_ingested"] == len(sel)
    write_json(f"{st.landing}/ipca.json", ipc)
    old = os.stat(f"{st.landing}/ipca.json").st_mtime - 30 * 86_400
    os.utime(f"{st.landing}/ipca.json", (old, old))
    assert missing_files(spark, st.landing, read_bronze(spark, st.bronze_path)).count() == 1
    assert ingest(spark, st)["rows_ingested"] == len(ipc)
    assert missing_files(spark, st.landing, read_bronze(spark, st.bronze_path)).isEmpty()


def test_absent_folder_has_no_files_and_other_errors_are_raised(spark, root, monkeypatch):
    assert files_in(spark, f"{root}/nowhere") == 0
    monkeypatch.setattr("ratelake.sources.landing.count_files", lambda *a: spark.sql("SELECT no_such_column"))
    with pytest.raises(AnalysisException):
        files_in(spark, root)


def test_stream_once_per_file(spark, root):
    st = settings_for(root)
    n = _land(st)
    m1 = ingest(spark, st)
    m2 = ingest(spark, st)
    assert (m1["rows_ingested"], m2["rows_ingested"], m2["rows_after"]) == (n, 0, n)
    assert m1["landing_files"] == 2
    # the same name overwritten is read again, once; and so is a new name
    sel, _ = series_payload(months=1, days=3, daily="0.06")
    write_json(f"{st.landing}/selic.json", sel)
    again = ingest(spark, st)
    assert (again["rows_ingested"], again["files_changed"]) == (3, 1)
    assert ingest(spark, st)["rows_ingested"] == 0
    write_json(f"{st.landing}/selic_2025.json", sel)
    assert ingest(spark, st)["rows_ingested"] == 3
    b = read_bronze(spark, st.bronze_path)
    assert b.select("ingested_at").distinct().count() == 3


def test_multiline_off_breaks_parse_and_gate_catches_it(spark, root):
    st = settings_for(root, multi_line=False)
    _land(st)
    with pytest.raises(DataQualityError) as e:
        run(spark, st)
    assert "never(no raw field)" in str(e.value)


def test_layered_run_clean_and_idempotent(spark, root):
    st = settings_for(root)
    n = _land(st)
    r1 = run(spark, st)
    assert r1.passed and len(r1.results) == 24
    assert r1.metrics["bronze"]["rows_ingested"] == n
    assert r1.metrics["silver"]["rows_inserted"] == n
    assert r1.metrics["gold"]["rows"] == 24
    r2 = run(spark, st)
    assert r2.metrics["bronze"]["rows_ingested"] == 0
    assert (r2.metrics["silver"]["rows_inserted"], r2.metrics["silver"]["rows_updated"]) == (0, 0)
    assert r2.metrics["silver"]["rows_total"] == n and r2.metrics["gold"]["rows"] == 24


def test_resent_file_with_new_name_updates_without_duplicates(spark, root):
    st = settings_for(root)
    n = _land(st)
    run(spark, st)
    sel, _ = series_payload(months=24, days=20)
    write_json(f"{st.landing}/selic_2020-2021.json", sel)
    r = run(spark, st)
    s = r.metrics["silver"]
    assert r.passed and s["rows_total"] == n and s["rows_inserted"] == 0 and s["rows_updated"] == len(sel)
    assert s["rows_changed"] == 0  # same values, newer ingest: updated, not changed
    sel2, _ = series_payload(months=1, days=3, daily="0.07")
    write_json(f"{st.landing}/selic_2020-01.json", sel2)
    s2 = run(spark, st).metrics["silver"]
    assert (s2["rows_updated"], s2["rows_changed"]) == (3, 3)


def test_backfill_extends_window(spark, root):
    from ratelake.plans.runner import backfill

    st = settings_for(root, months=12, start="2021-01")
    sel, ipc = series_payload(months=12, start=(2021, 1))
    write_json(f"{st.landing}/selic.json", sel)
    write_json(f"{st.landing}/ipca.json", ipc)
    assert run(spark, st).passed
    sel, ipc = series_payload(months=12, start=(2020, 1))
    write_json(f"{st.landing}/selic_2020.json", sel)
    write_json(f"{st.landing}/ipca_2020.json", ipc)
    r = backfill(spark, st, "2020-01")
    assert r.passed and r.metrics["gold"]["rows"] == 24 and r.metrics["silver"]["rows_inserted"] == len(sel) + len(ipc)


def test_gate_stops_the_run(spark, root):
    st = settings_for(root)
    sel, ipc = series_payload(months=24)
    write_json(f"{st.landing}/selic.json", sel)  # no inflation file
    with pytest.raises(DataQualityError) as e:
        run(spark, st)
    assert "series_present" in str(e.value)


def test_incremental_silver_in_several_batches(spark, root):
    st = settings_for(root, max_files_per_trigger=1)
    n = _land(st)
    write_json(f"{st.landing}/selic_2020-01.json", series_payload(months=1, days=3, daily="0.07")[0])
    ingest(spark, st)
    out = incremental_silver(spark, st)
    assert out["batches"] >= 2 and out["rows_inserted"] == n and out["rows_total"] == n
    assert out["rows_inserted"] + out["rows_updated"] + out["rows_matched_noop"] == n + 3  # summed over the batches
    assert silver_table(spark, st).read().filter("value = 0.07").count() == 3
    again = incremental_silver(spark, st)
    assert (again["batches"], again["rows_inserted"], again["rows_total"]) == (0, 0, n)  # nothing new


def test_incremental_silver_replay_is_keyed_by_stream(spark, root):
    st = settings_for(root)
    n = _land(st)
    ingest(spark, st)
    incremental_silver(spark, st, checkpoint=f"{root}/ckpt-a")
    # a second stream over the same Bronze starts again at batch 0: it must
    # not be mistaken for a replay, and its upsert changes nothing
    out = incremental_silver(spark, st, checkpoint=f"{root}/ckpt-b")
    table = silver_table(spark, st)
    assert out["batches"] >= 1 and table.count() == n
    last = table.history().orderBy(F.col("version").desc()).first().metrics
    assert last["rows_inserted"] == "0" and last["stream"].endswith("ckpt-b")

"""What runs keep up beside the tables: month state, file ledger, Gold's versions."""

import datetime as dt
import io
import os
import random
import re
from contextlib import redirect_stdout
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import series_payload, settings_for, write_json
from ratelake.operators.month_state import month_state
from ratelake.plans.checks import fresh_state, ledger_results, silver_results, state_results
from ratelake.plans.gold import build_gold
from ratelake.plans.runner import gold_table, run, silver_table
from ratelake.schemas import GOLD, SILVER, SILVER_KEY
from ratelake.streaming.ledger import changed_files, landed_files, read_ledger


def _land(st, months=24, **kw):
    sel, ipc = series_payload(months=months, days=20, **kw)
    write_json(f"{st.landing}/selic.json", sel)
    write_json(f"{st.landing}/ipca.json", ipc)
    return len(sel) + len(ipc)


def _plan(df):
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def _rows(df, drop=("processed_at",)):
    return sorted(map(str, df.drop(*drop).collect()))


def _touch_later(path, seconds=5):
    t = os.stat(path).st_mtime + seconds
    os.utime(path, (t, t))


def test_state_follows_any_merges(spark, root):
    """After random merges the state equals a full recount, and so do the rules."""
    st = settings_for(root, months=30, silver_buckets=3)
    table = silver_table(spark, st)
    rng = random.Random(4)
    for step in range(5):
        rows = {}
        for _ in range(40):
            sid, name = rng.choice([(11, "selic"), (433, "ipca")])
            day = dt.date(2020 + rng.randrange(3), rng.randrange(1, 13), rng.choice([1, 1, 2, 15]))
            value = Decimal(rng.choice(["0.05", "0.5", "2", "-101", "12"]))
            ts = dt.datetime(2024, 1, 1 + rng.randrange(20))
            rows[sid, day] = (sid, name, None if rng.random() < 0.1 else "x", day, f"{day:%Y-%m}", value, "f", ts, ts)
        table.merge(spark.createDataFrame(list(rows.values()), SILVER), SILVER_KEY, "ingested_at")
        stored = table.read()
        want = month_state(stored, st.series)
        rounded = [F.round(c, 12).alias(c) if c == "log_sum" else c for c in want.columns]  # a sum of doubles has no order
        assert _rows(table.state().select(*rounded)) == _rows(want.select(*rounded))
        assert _rows(state_results(table.state(), st)) == _rows(silver_results(stored, st))
    changed = st.with_(series=tuple(s.__class__(**{**s.__dict__, "domain": (0.0, 0.1)}) for s in st.series))
    other = silver_table(spark, changed)
    assert _rows(state_results(fresh_state(other, changed), changed)) == _rows(silver_results(other.read(), changed))


def test_gates_of_a_run_read_no_layer(spark, root):
    st = settings_for(root)
    _land(st)
    assert run(spark, st).passed
    ledger = read_ledger(spark, st)
    plan = _plan(state_results(fresh_state(silver_table(spark, st), st), st, ledger)) + _plan(ledger_results(ledger, st, 2))
    places = set(re.findall(r"tables/(\w+)", plan))
    assert places == {"silver_state", "bronze_files"}


def test_changed_file_is_read_again_once(spark, root):
    st = settings_for(root)
    odd = f"{st.landing}/a b{{1,2}}[x]%41+c*"  # special to globs and to URLs
    sel, ipc = series_payload(months=24, days=20)
    write_json(f"{odd}/selic.json", sel)
    write_json(f"{odd}/ipca.json", ipc)
    n = len(sel) + len(ipc)
    assert run(spark, st).passed
    sel[0]["valor"] = "0.09"
    write_json(f"{odd}/selic.json", sel)
    _touch_later(f"{odd}/selic.json")
    assert changed_files(landed_files(spark, st), read_ledger(spark, st)).count() == 1
    report = run(spark, st)
    assert report.passed and report.metrics["bronze"]["files_changed"] == 1
    assert report.metrics["bronze"]["rows_ingested"] == len(sel)
    silver = silver_table(spark, st).read()
    assert silver.count() == n and silver.where("value = 0.09").count() == 1
    assert _rows(gold_table(spark, st).read()) == _rows(build_gold(silver, st))
    again = run(spark, st).metrics
    assert again["bronze"]["rows_ingested"] == again["bronze"]["files_changed"] == 0 and not again["gold"]["committed"]


def test_unread_change_breaks_its_rule(spark, root):
    st = settings_for(root)
    _land(st)
    assert run(spark, st).passed
    _touch_later(f"{st.landing}/selic.json")
    got = {r.name: r.observed for r in ledger_results(read_ledger(spark, st), st, 2).collect()}
    assert got["landing_files_changed"] == "1" and got["landing_files_without_rows"] == "0"


@pytest.mark.parametrize("options", [{}, {"rolling_frame": "months"}, {"rolling_gate": "factors", "rolling_months": 3}])
def test_incremental_gold_equals_rebuild(spark, root, options):
    st = settings_for(root, months=30, **options)
    _land(st, months=30)
    run(spark, st, stop_on_failure=False)
    files = {os.path.join(d, f) for d, _, fs in os.walk(st.gold_path) for f in fs}
    assert not run(spark, st, stop_on_failure=False).metrics["gold"]["committed"]
    assert files == {os.path.join(d, f) for d, _, fs in os.walk(st.gold_path) for f in fs}
    for name, day in (("selic_2021-03", "05/03/2021"), ("selic_2023", "01/06/2023"), ("ipca_2019", "01/12/2019")):
        write_json(f"{st.landing}/{name}.json", [{"data": day, "valor": "0.31"}])
        before = gold_table(spark, st).read().select("year_month", F.col("processed_at").cast("string")).collect()
        assert run(spark, st, stop_on_failure=False).metrics["gold"]["committed"]
        now = gold_table(spark, st).read()
        assert _rows(now) == _rows(build_gold(silver_table(spark, st).read(), st))
        if name == "selic_2021-03":  # months before the change were taken over
            kept = dict(now.select("year_month", F.col("processed_at").cast("string")).collect())
            assert all(kept[m] == t for m, t in before if m < "2021-03")
            assert any(kept[m] != t for m, t in before if m >= "2021-03")


def test_gold_of_another_definition_is_built_anew(spark, root):
    st = settings_for(root)
    _land(st)
    run(spark, st)
    other = st.with_(rolling_months=6)
    run(spark, other, stop_on_failure=False)
    assert _rows(gold_table(spark, st).read()) == _rows(build_gold(silver_table(spark, st).read(), other))


def test_readers_keep_the_old_gold_while_a_write_dies(spark, root):
    st = settings_for(root)
    table = gold_table(spark, st)
    row = {f.name: None for f in GOLD} | {"year_month": "2020-01"}
    good = spark.createDataFrame([tuple(row.values())], GOLD)
    table.overwrite(good)
    assert table.location() and table.count() == 1
    dies = spark.range(50, numPartitions=5).select(
        F.when(F.col("id") == 49, F.raise_error(F.lit("lost"))).otherwise(F.lit("2020-02")).alias("year_month"),
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in GOLD if f.name != "year_month"],
    )
    with pytest.raises(Exception, match="lost"):
        table.overwrite(dies)
    assert [r.year_month for r in table.read().collect()] == ["2020-01"]
    reader = table.read()  # a reader that began before the next version is published
    table.overwrite(good.withColumn("year_month", F.lit("2020-03")))
    assert [r.year_month for r in reader.collect()] == ["2020-01"]
    assert [r.year_month for r in table.read().collect()] == ["2020-03"]
    folders = [d for d in os.listdir(st.gold_path) if d.startswith("v-")]
    assert len(folders) == 2  # the current version and the one before


def test_schema_of_a_named_versioned_table_is_replaced(spark, root):
    from pyspark.sql import types as T

    from ratelake.sources.tables import StoredTable

    spark.sql(f"CREATE SCHEMA IF NOT EXISTS state_test LOCATION '{root}/catalog'")
    one = T.StructType([T.StructField("a", T.IntegerType())])
    two = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    text = "it's a \\ table"
    StoredTable(spark, f"{root}/t", one, None, "state_test.t", text, versioned=True).overwrite(spark.createDataFrame([(1,)], one))
    assert spark.table("state_test.t").columns == ["a"]
    later = StoredTable(spark, f"{root}/t", two, None, "state_test.t", text, versioned=True)
    later.overwrite(spark.createDataFrame([(1, "x"), (2, "y")], two))
    assert sorted(map(tuple, spark.table("state_test.t").collect())) == [(1, "x"), (2, "y")]
    later.overwrite(spark.createDataFrame([(3, "z")], two))
    assert [tuple(r) for r in spark.table("state_test.t").collect()] == [(3, "z")]
    described = {r.col_name: r.data_type for r in spark.sql("DESCRIBE TABLE EXTENDED state_test.t").collect()}
    assert described["Comment"] == text
    spark.sql("DROP TABLE state_test.t")


def test_period_in_a_file_name_is_a_year_or_month():
    from ratelake.settings import file_pattern

    ipca = re.compile(file_pattern("ipca"))
    for name in ("ipca.json", "x/ipca.json", "ipca_2020.json", "ipca-2020_2024.json", "ipca_202001.json", "ipca_2020-01_2020-12.json"):
        assert ipca.search(name), name
    for name in ("ipca-15.json", "ipca_15.json", "ipca15.json", "ipca-432.json", "ipca_meta.json", "ipca_2020-13.json", "xipca.json", "ipca_202.json"):
        assert not ipca.search(name), name
    assert not re.search(file_pattern("selic"), "selic-432.json")


def test_series_are_mapped_once_a_file(spark):
    from ratelake.operators.conform import typed
    from ratelake.settings import DEFAULT_SERIES, SeriesSpec

    rows = spark.range(30_000).select(
        F.lit("01/01/2020").alias("date_raw"), F.lit("1").alias("value_raw"),
        F.element_at(F.array(*[F.lit(x) for x in ("a/selic.json", "a/ipca-15.json", "ipca_2020.json")]), (F.col("id") % 3 + 1).cast("int")).alias("source_file"),
        F.current_timestamp().alias("file_modified_at"), F.current_timestamp().alias("ingested_at"),
    )
    many = DEFAULT_SERIES + tuple(SeriesSpec(1000 + i, f"s{i}", "x", "%", f"(^|/)s{i}[.]json$", (0.0, 1.0)) for i in range(300))
    got = typed(rows, many)
    assert {(r.source_file, r.series_id): r["count"] for r in got.groupBy("source_file", "series_id").count().collect()} == {
        ("a/selic.json", 11): 10_000, ("a/ipca-15.json", None): 10_000, ("ipca_2020.json", 433): 10_000,
    }
    plan = _plan(got)
    # the patterns are tried above the aggregation of file names, on no other path to the rows
    assert plan.count("RLIKE") + plan.count("rlike") >= 1 and "HashAggregate" in plan
    top = plan[: plan.index("HashAggregate")]
    assert "BroadcastHashJoin" in top or "SortMergeJoin" in top


def test_runs_leave_no_scratch_tables(spark, root):
    from ratelake.session import shared_root

    shared = shared_root(spark).removeprefix("file:")
    before = set(os.listdir(shared))
    for k, options in enumerate(({}, {"silver_mode": "batch"}, {"silver_mode": "batch", "gate_mode": "before_commit"})):
        st = settings_for(f"{root}/{k}", **options)
        _land(st)
        assert run(spark, st).passed and run(spark, st).passed
    left = {p.rsplit("-", 1)[0] for p in set(os.listdir(shared)) - before}
    assert not left & {"merged", "silver-batch", "silver-staging", "rebuild"}

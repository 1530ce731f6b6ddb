"""Physical-plan properties that matter at scale (read from explain())."""

import io
import re
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from helpers import OBS_SCHEMA, obs_rows, settings_for
from ratelake.operators.dedup import latest_wins
from ratelake.operators.upsert import merge_changes
from ratelake.plans.gold import build_gold


def plan(df, mode="formatted") -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def scans(p: str) -> int:
    return len(re.findall(r"^\(\d+\) Scan parquet", p, re.M))


def _silver_on_disk(spark, root):
    path = f"{root}/silver_plain"
    obs = spark.createDataFrame(obs_rows(months=24), OBS_SCHEMA)
    obs.withColumn("source_file", F.lit("x")).write.parquet(path)
    return spark.read.parquet(path)


def test_onepass_gold_prunes_columns_pushes_filter_and_does_not_join(spark, root):
    silver = _silver_on_disk(spark, root)
    p = plan(build_gold(silver, settings_for(root), strategy="onepass"))
    assert "PushedFilters: [In(series_name, [ipca,selic])]" in p
    assert "ReadSchema: struct<series_name:string,year_month:string,value:decimal(18,8)>" in p
    assert "Join" not in p
    assert scans(p) == 1
    assert "partial_sum" in p  # map-side combine before the shuffle


def test_join_gold_scans_twice_with_sort_merge_full_outer(spark, root):
    silver = _silver_on_disk(spark, root)
    p = plan(build_gold(silver, settings_for(root), strategy="join"))
    assert scans(p) == 2 and "FullOuter" in p


def test_rolling_by_entity_is_hash_partitioned_not_single(spark):
    df = spark.createDataFrame([("a", "2020-01", 1.01)], "e string, year_month string, f double")
    from ratelake.operators.rolling import rolling_compound

    p = plan(rolling_compound(df, {"x": "f"}, partition_by=["e"]))
    assert "hashpartitioning(e" in p and "SinglePartition" not in p


def test_dedup_has_partial_limit_before_exchange(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    p = plan(latest_wins(df, ["k"], [F.col("v").desc()]))
    # formatted plans number operators from the leaves: the partial limit
    # sits before the shuffle, the final one after it
    partial = p.index("row_number(), 1, Partial")
    exchange = p.index("Arguments: hashpartitioning(k")
    final = p.index("row_number(), 1, Final")
    assert partial < exchange < final


def test_upsert_reuses_key_partitioning(spark):
    t = spark.range(100).select(F.col("id").alias("k"), F.lit("a").alias("v"), F.current_timestamp().alias("ts"))
    s = t.filter("k < 10")
    p = plan(merge_changes(t.repartition(8, "k"), s.repartition(8, "k"), ["k"], "ts"))
    assert "FullOuter" in p
    # one exchange a side, the ones asked for: the join adds none
    assert p.count("Arguments: hashpartitioning(k") == 2


def test_merge_reads_and_writes_only_touched_partitions(spark, root):
    import datetime as dt
    import os

    from ratelake.plans.runner import silver_table
    from ratelake.schemas import SILVER, SILVER_KEY

    st = settings_for(root)
    old, new = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)

    def rows(months, ts, value):  # a folder holds a year: one row in each
        return spark.createDataFrame([(11, "selic", "diaria", dt.date(2010 + m, 1, 1), f"{2010 + m}-01", value, "f", ts, ts) for m in months], SILVER)

    def files():
        return {os.path.join(d, f) for d, _, fs in os.walk(st.silver_path) for f in fs if f.startswith("part-")}

    from decimal import Decimal

    table = silver_table(spark, st)
    assert table.merge(rows(range(1, 7), old, Decimal(1)), SILVER_KEY, "ingested_at")["rows_inserted"] == 6
    before = files()
    # an older and an equal ingest change nothing: no data file is written
    got = table.merge(rows(range(1, 7), old, Decimal(9)), SILVER_KEY, "ingested_at")
    assert (got["rows_matched_noop"], got["rows_updated"]) == (6, 0) and files() == before
    got = table.merge(rows([3, 8], new, Decimal(2)), SILVER_KEY, "ingested_at")
    assert (got["rows_updated"], got["rows_inserted"], got["rows_untouched"]) == (1, 1, 5)
    changed = {f.split("ref_year=")[1][:4] for f in before ^ files()}
    assert changed == {"2013", "2018"}
    assert {r.year_month: r.value for r in table.read().collect()} == {
        f"{2010 + m}-01": Decimal(2 if m in (3, 8) else 1) for m in (1, 2, 3, 4, 5, 6, 8)
    }
    by = list(table.layout)
    p = plan(table._stored().join(table._placed(rows([3], new, Decimal(2))).select(*by).distinct(), by, "left_semi"))
    assert re.search(r"PartitionFilters: \[[^\]]*ref_year", p)


def test_cluster_settings_follow_the_shuffled_bytes():
    from ratelake.session import MAX_SHUFFLE_PARTITIONS, cluster_settings

    rollup = cluster_settings(1 << 30, executor_cores=4, executors=10)
    big = cluster_settings(100 << 40, executor_cores=8, executors=1000)
    assert rollup["spark.sql.shuffle.partitions"] == "80"  # two waves of 40 slots
    assert int(big["spark.sql.shuffle.partitions"]) == MAX_SHUFFLE_PARTITIONS
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"

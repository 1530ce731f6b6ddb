"""Keyed conditional upsert: branches, idempotence, errors, history."""

import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.errors.exceptions.base import UnsupportedOperationException
from pyspark.sql import functions as F

from ratelake.operators.upsert import (
    DuplicateSourceKeyError,
    assert_unique_keys,
    change_counts,
    merge_changes,
    merge_into,
    upsert,
)
from ratelake.sources.tables import StoredTable

SCHEMA = "k int, ym string, v string, ts timestamp"
T = [dt.datetime(2024, 1, d) for d in range(1, 6)]


def _frames(spark):
    target = spark.createDataFrame(
        [
            (1, "2024-01", "old", T[2]),  # source older  -> noop
            (2, "2024-01", "old", T[2]),  # source equal  -> noop
            (3, "2024-01", "old", T[2]),  # source newer  -> update
            (5, "2024-02", "old", None),  # NULL target time -> noop
            (6, "2024-03", "keep", T[2]),  # no source   -> untouched
        ],
        SCHEMA,
    )
    source = spark.createDataFrame(
        [
            (1, "2024-01", "new", T[1]),
            (2, "2024-01", "new", T[2]),
            (3, "2024-01", "new", T[3]),
            (4, "2024-02", "new", T[3]),  # not in target -> insert
            (5, "2024-02", "new", T[3]),
        ],
        SCHEMA,
    )
    return target, source


def test_merge_branches(spark):
    t, s = _frames(spark)
    got = {r.k: (r.v, r._change) for r in merge_changes(t, s, ["k"], "ts").collect()}
    assert got == {
        1: ("old", "matched_noop"),
        2: ("old", "matched_noop"),
        3: ("new", "updated"),
        4: ("new", "inserted"),
        5: ("old", "matched_noop"),
        6: ("keep", "untouched"),
    }


def test_pruned_merge_equals_full(spark):
    t, s = _frames(spark)
    a = merge_changes(t, s, ["k"], "ts")
    b = merge_changes(t, s, ["k"], "ts", prune_by=["k % 2"])
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_counters_sum_to_size(spark):
    t, s = _frames(spark)
    c = change_counts(merge_changes(t, s, ["k"], "ts")).first()
    assert (c.rows_inserted, c.rows_updated, c.rows_matched_noop, c.rows_untouched) == (1, 1, 3, 1)
    assert c.rows_inserted + c.rows_updated + c.rows_matched_noop + c.rows_untouched == c.rows_total == 6


def test_upsert_twice_equals_once(spark):
    t, s = _frames(spark)
    once = upsert(t, s, ["k"], "ts")
    twice = upsert(once, s, ["k"], "ts")
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0
    c = change_counts(merge_changes(once, s, ["k"], "ts")).first()
    assert c.rows_inserted == 0 and c.rows_updated == 0


def test_duplicate_source_key_raises(spark):
    s = spark.createDataFrame([(1, "a", "x", T[0]), (1, "a", "y", T[1])], SCHEMA)
    with pytest.raises(DuplicateSourceKeyError):
        assert_unique_keys(s, ["k"])


def _table(spark, path):
    return StoredTable(spark, path, spark.createDataFrame([], SCHEMA).schema)


def test_stored_table_history(spark, root):
    t, s = _frames(spark)
    table = _table(spark, f"{root}/tbl")
    m0, m1, m2 = (table.merge(x, ["k"], "ts") for x in (t, s, s))
    assert (m0["rows_inserted"], m0["rows_total"]) == (5, 5)
    assert (m1["rows_inserted"], m1["rows_updated"], m1["rows_total"]) == (1, 1, 6)
    assert (m2["rows_inserted"], m2["rows_updated"]) == (0, 0)
    h = table.history().selectExpr("version", "operation", "CAST(metrics['rows_inserted'] AS BIGINT) AS ins").collect()
    assert [(r.version, r.operation, r.ins) for r in h] == [(0, "MERGE", 5), (1, "MERGE", 1), (2, "MERGE", 0)]
    assert table.read().columns == ["k", "ym", "v", "ts"] and table.count() == 6


def test_refused_rows_are_not_stored(spark, root):
    t, s = _frames(spark)
    table = _table(spark, f"{root}/tbl2")
    seen = []
    table.merge(t, ["k"], "ts")
    got = table.merge(s, ["k"], "ts", accept=lambda df: seen.append(df.count()) or False)
    assert seen == [6] and not got["committed"] and table.count() == 5 and table.history().count() == 1
    assert not table.overwrite(s, accept=lambda df: False)["committed"] and table.count() == 5
    assert table.overwrite(s, accept=lambda df: True)["committed"] and table.count() == 5


def test_duplicate_source_key_stops_the_merge(spark, root):
    t, _ = _frames(spark)
    with pytest.raises(DuplicateSourceKeyError):
        _table(spark, f"{root}/tbl3").merge(t.union(t), ["k"], "ts")


def test_pruned_merge_with_moved_and_null_columns(spark):
    """Rows that match on the key but moved in other columns, or hold NULL there."""
    target = spark.createDataFrame([(k, ym, "old", T[2]) for k, ym in ((1, "a"), (2, None), (3, "c"), (4, "d"), (None, "e"))], SCHEMA)
    source = spark.createDataFrame([(k, ym, "new", T[3]) for k, ym in ((1, "z"), (2, "b"), (3, None), (7, None), (None, None))], SCHEMA)
    a = merge_changes(target, source, ["k"], "ts", compare=["ym"])
    for prune in (["k"], ["k div 2"], ["k % 2", "k > 2"]):
        b = merge_changes(target, source, ["k"], "ts", prune_by=prune, compare=["ym"])
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    with pytest.raises(AnalysisException):
        merge_changes(target, source, ["k"], "ts", prune_by=["ym"])  # not of the key


def test_merge_into_needs_a_table_with_row_level_operations(spark, root):
    t, s = _frames(spark)
    t.write.mode("overwrite").option("path", f"{root}/plain").saveAsTable("plain_target")
    with pytest.raises(UnsupportedOperationException, match="does not support MERGE"):
        merge_into(s, "plain_target", ["k"], "ts")
    spark.sql("DROP TABLE plain_target")



def test_values_changed_separates_refresh_from_change(spark):
    t, s = _frames(spark)
    same = t.filter("k = 3").withColumn("ts", F.lit(T[4]))  # newer, same value
    got = change_counts(merge_changes(t, same, ["k"], "ts", compare=["v"])).first()
    assert (got.rows_updated, got.rows_changed) == (1, 0)
    got = change_counts(merge_changes(t, s, ["k"], "ts", compare=["v"])).first()
    assert (got.rows_updated, got.rows_changed) == (1, 1)
    pruned = change_counts(merge_changes(t, s, ["k"], "ts", compare=["v"], prune_by=["k % 3"])).first()
    assert pruned.asDict() == got.asDict()

"""Property tests: compounding algebra, Fisher identity, upsert laws."""

import datetime as dt
import math
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ratelake.functions.rates import compound
from ratelake.operators.upsert import change_counts, merge_changes, upsert

SLOW = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

rates = st.lists(st.floats(min_value=-5, max_value=10, allow_nan=False), min_size=1, max_size=40)


@SLOW
@given(rates)
def test_exp_ln_equals_product_and_is_order_free(spark, vals):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, r double")
    a = df.agg(compound("r")).first()[0]
    b = df.orderBy(F.desc("i")).repartition(3).agg(compound("r")).first()[0]
    p = 1.0
    for v in vals:
        p *= 1 + v / 100
    assert math.isclose(a, p, rel_tol=1e-12) and math.isclose(a, b, rel_tol=1e-12)


@SLOW
@given(st.floats(min_value=-5, max_value=50), st.floats(min_value=-5, max_value=10))
def test_fisher_identity_holds_on_stored_decimals(spark, policy, inflation):
    df = spark.createDataFrame([(policy, inflation)], "p double, i double")
    fp, fi = F.lit(1) + F.col("p") / 100, F.lit(1) + F.col("i") / 100
    real = ((fp / fi - 1) * 100).cast("decimal(18,8)")
    row = df.select(
        F.col("p").cast("decimal(18,8)").alias("p"), F.col("i").cast("decimal(18,8)").alias("i"), real.alias("r")
    ).first()
    gap = abs((1 + float(row.r) / 100) * (1 + float(row.i) / 100) - (1 + float(row.p) / 100))
    assert gap <= 1e-6


keys = st.integers(min_value=0, max_value=12)
times = st.integers(min_value=0, max_value=5)
rows = st.lists(st.tuples(keys, times, st.integers(0, 3)), max_size=20, unique_by=lambda r: r[0])


def _frame(spark, data):
    base = dt.datetime(2024, 1, 1)
    return spark.createDataFrame(
        [(k, base + dt.timedelta(days=t), Decimal(v)) for k, t, v in data], "k int, ts timestamp, v decimal(18,8)"
    )


@SLOW
@given(rows, rows)
def test_upsert_laws(spark, target, source):
    t, s = _frame(spark, target), _frame(spark, source)
    once = upsert(t, s, ["k"], "ts")
    twice = upsert(once, s, ["k"], "ts")
    # idempotent
    assert sorted(once.collect()) == sorted(twice.collect())
    c = change_counts(merge_changes(t, s, ["k"], "ts")).first()
    # counters partition the result; inserts are exactly the new keys
    assert c.rows_inserted + c.rows_updated + c.rows_matched_noop + c.rows_untouched == c.rows_total
    assert c.rows_total == len({r[0] for r in target} | {r[0] for r in source})
    assert c.rows_inserted == len({r[0] for r in source} - {r[0] for r in target})
    # every result row carries the newest timestamp seen for its key
    newest = {}
    for k, tt, _ in target + source:
        newest[k] = max(newest.get(k, -1), tt)
    got = {r.k: r.ts for r in once.collect()}
    assert all((got[k] - dt.datetime(2024, 1, 1)).days == newest[k] for k in got)

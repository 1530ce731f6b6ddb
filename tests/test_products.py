"""Products of factors of any sign, and windows dealt over blocks."""

import io
import math
import random
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from ratelake.functions.rates import product
from ratelake.operators.rolling import numbered, rolling_compound, rolling_in_blocks


def test_product_against_plain_products(spark):
    rng = random.Random(9)
    groups = {g: [rng.choice([None, 0.0, -1.5, 2.0, 1.01, -0.2, 3.0]) for _ in range(rng.randrange(0, 12))] for g in range(200)}
    groups |= {1000: [None, None], 1001: [0.0], 1002: [-2.0], 1003: [-1.0] * 7}
    rows = [(g, i, f) for g, fs in groups.items() for i, f in enumerate(fs)]
    df = spark.createDataFrame(rows, "g int, i int, f double").repartition(5)
    got = {r.g: r.p for r in df.groupBy("g").agg(product("f").alias("p")).collect()}
    for g, p in got.items():
        known = [f for f in groups[g] if f is not None]
        assert (p is None) if not known else math.isclose(p, math.prod(known), rel_tol=1e-12, abs_tol=0)
    window = rolling_compound(df, {"p3": "f"}, order_by="i", partition_by=["g"], months=3, signed=True).collect()
    for r in window:
        known = [f for f in groups[r.g][max(0, r.i - 2) : r.i + 1] if f is not None]
        if r.i < 2 or not known:
            assert r.p3 is None
        else:
            assert math.isclose(r.p3, (math.prod(known) - 1) * 100, rel_tol=1e-9, abs_tol=1e-9)


def test_long_products_are_exact_and_never_end_the_query(spark, root):
    from ratelake.plans.registry import QUERIES

    rng = random.Random(4)
    groups = {g: [rng.choice([-24, -17, -7, 3, 11, 23]) for _ in range(rng.randrange(9, 12))] for g in range(200)}
    groups |= {900: [24] * 40, 901: [-24] * 41, 902: [24] * 300, 903: [24] * 300 + [0], 904: [2] * 63, 905: [-2] * 63, 906: [2] * 62, 907: [1]}
    rows = [(g, i, float(f + 25)) for g, fs in groups.items() for i, f in enumerate(fs)] + [(908, 0, None)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_quantity double").repartition(7).write.parquet(f"{root}/lineitem.parquet")
    got = {r.l_orderkey: (r.whole, r.rows) for r in QUERIES["signed_product_rollup"](spark, root).collect()}
    want = {g: (p if -(2**63) <= (p := math.prod(fs)) < 2**63 else None, len(fs)) for g, fs in groups.items()}
    assert got == want | {908: (None, 1)}


def test_products_that_leave_the_range_on_the_way(spark):
    factors = [1e200] * 3 + [-1e-200] * 3 + [2.0]
    for own in (factors, factors[::-1]):
        df = spark.createDataFrame([(f,) for f in own], "f double").coalesce(1)
        assert math.isclose(df.agg(product("f").alias("p")).first().p, -2.0, rel_tol=1e-9)


@pytest.mark.parametrize("frame,by", [("rows", []), ("months", []), ("rows", ["e"]), ("months", ["e"])])
def test_blocks_give_the_very_same_numbers(spark, frame, by):
    rng = random.Random(2)
    rows = []
    for e, n in (("long", 900), ("short", 5), (None, 30)) if by else (("only", 900),):
        for m in range(n):
            if rng.random() < 0.9:
                rows.append((e, f"{1900 + m // 12}-{m % 12 + 1:02d}", rng.choice([None, 1.01, 0.99, 1.5]), "kept"))
    df = spark.createDataFrame(rows, "e string, year_month string, f double, other string").repartition(6)
    for gate in ("rows", "factors"):
        plain = rolling_compound(df, {"r": "f"}, partition_by=by, one_series=not by, frame=frame, gate=gate)
        dealt = rolling_in_blocks(df, {"r": "f"}, partition_by=by, frame=frame, gate=gate, block_rows=13)
        assert dealt.columns == plain.columns
        assert sorted(map(str, dealt.collect())) == sorted(map(str, plain.collect()))
    with pytest.raises(ValueError):
        rolling_in_blocks(df, {"r": "f"}, block_rows=5)


def test_a_million_rows_without_one_task(spark):
    df = spark.range(1_000_000).select(F.col("id").alias("k"), (1 + F.rand(3) / 1000).alias("f"))
    dealt = rolling_in_blocks(df, {"r": "f"}, order_by="k", block_rows=50_000)
    buf = io.StringIO()
    with redirect_stdout(buf):
        dealt.explain("formatted")
    plan = buf.getvalue()
    # one small exchange to one place: the counts of the partitions, after their aggregation
    assert plan.count("SinglePartition") == 1
    plain = rolling_compound(df, {"r": "f"}, order_by="k", one_series=True)
    digest = lambda x: x.agg(F.count("r"), F.sum(F.xxhash64("k", "r", "months_in_window").cast("decimal(38,0)"))).first()
    assert digest(dealt) == digest(plain)


def test_numbers_have_no_gaps(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("e"), F.col("id").alias("k"), F.lit(1).alias("number_"))
    got = numbered(df.repartition(7), "k", ["e"]).collect()
    by = {}
    for r in sorted(got, key=lambda r: r.k):
        by.setdefault(r.e, []).append(r.number)
    assert all(v == list(range(1, len(v) + 1)) for v in by.values())
    assert numbered(df.where("false"), "k").count() == 0

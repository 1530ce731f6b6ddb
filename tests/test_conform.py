"""Tolerant typing, file -> series mapping and latest-wins de-duplication."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ratelake.functions.parsing import parse_date, parse_decimal
from ratelake.operators.conform import conform, rejection_counts
from ratelake.operators.dedup import latest_wins
from ratelake.schemas import BRONZE
from ratelake.settings import DEFAULT_SERIES

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)
T1 = dt.datetime(2024, 1, 2, 10, 0, 0)


def test_date_edge_cases(spark):
    cases = ["01/01/2020", "31/02/2020", "1/1/2020", "2020-01-01", None]
    df = spark.createDataFrame([(c,) for c in cases], "s string")
    got = [r.d for r in df.select(parse_date("s").alias("d")).collect()]
    assert got == [dt.date(2020, 1, 1), None, None, None, None]


def test_decimal_edge_cases(spark):
    cases = [" 0.05 ", "1e-3", "0.123456785", "abc", "", "0,05", "12345678901", None]
    df = spark.createDataFrame([(c,) for c in cases], "s string")
    got = [r.v for r in df.select(parse_decimal("s").alias("v")).collect()]
    assert got == [Decimal("0.05"), Decimal("0.001"), Decimal("0.12345679"), None, None, None, None, None]


def _bronze(spark, rows):
    return spark.createDataFrame(rows, BRONZE)


def test_series_mapping_by_name_and_prefix(spark):
    rows = [
        ("01/01/2020", "0.05", "/v/landing/selic.json", T0, T0),
        ("01/01/2015", "0.04", "/v/landing/selic_2015_2019.json", T0, T0),
        ("01/01/2020", "0.30", "/v/landing/ipca.json", T0, T0),
        ("01/01/2020", "0.30", "/v/landing/other.json", T0, T0),
    ]
    out = conform(_bronze(spark, rows), DEFAULT_SERIES).orderBy("ref_date", "series_id").collect()
    assert [(r.series_id, r.series_name, r.granularity) for r in out] == [
        (11, "selic", "diaria"),
        (11, "selic", "diaria"),
        (433, "ipca", "mensal"),
    ]
    c = rejection_counts(_bronze(spark, rows), DEFAULT_SERIES).first()
    assert (c.bronze_rows, c.rejected_rows, c.unmapped_rows) == (4, 0, 1)


def test_rejected_rows_are_dropped_and_counted(spark):
    rows = [
        ("01/01/2020", "0.05", "/l/selic.json", T0, T0),
        ("2020-01-02", "0.05", "/l/selic.json", T0, T0),
        ("03/01/2020", "abc", "/l/selic.json", T0, T0),
        (None, None, "/l/selic.json", T0, T0),
    ]
    b = _bronze(spark, rows)
    assert conform(b, DEFAULT_SERIES).count() == 1
    assert rejection_counts(b, DEFAULT_SERIES).first().rejected_rows == 3


def test_latest_ingest_wins(spark):
    rows = [
        ("01/01/2020", "0.05", "/l/selic.json", T0, T0),
        ("01/01/2020", "0.06", "/l/selic.json", T1, T1),
    ]
    out = conform(_bronze(spark, rows), DEFAULT_SERIES).collect()
    assert len(out) == 1 and out[0].value == Decimal("0.06") and out[0].year_month == "2020-01"


def test_ties_resolve_deterministically(spark):
    rows = [
        ("01/01/2020", "0.05", "/l/selic_2001.json", T0, T0),
        ("01/01/2020", "0.07", "/l/selic_2002.json", T0, T0),
        ("01/01/2020", "0.06", "/l/selic_2002.json", T0, T0),
    ]
    for parts in (1, 3):
        b = _bronze(spark, rows).repartition(parts)
        out = conform(b, DEFAULT_SERIES).collect()
        assert len(out) == 1 and out[0].source_file == "/l/selic_2002.json" and out[0].value == Decimal("0.07")


def test_dedup_plan_limits_before_shuffle(spark):
    import io
    from contextlib import redirect_stdout

    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    q = latest_wins(df, ["k"], [F.col("v").desc()])
    buf = io.StringIO()
    with redirect_stdout(buf):
        q.explain()
    assert "WindowGroupLimit" in buf.getvalue() and "Partial" in buf.getvalue()
    assert sorted(r.v for r in q.collect()) == [997, 998, 999]


def test_hot_key_dedup_keeps_one_row(spark):
    # one key holds a third of all rows
    df = spark.range(3000).select(
        F.when(F.col("id") < 1000, F.lit(0)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    out = latest_wins(df, ["k"], [F.col("v").desc()])
    assert out.count() == 2001
    assert out.filter("k = 0").first().v == 999


def test_file_names_map_to_series_exactly(spark):
    from ratelake.functions.series import series_attribute

    names = {
        "/l/selic.json": "selic", "/l/selic_2015_2019.json": "selic", "/l/ipca-2020-01.json": "ipca", "selic.json": "selic",
        "/l/selic_meta.json": None, "/l/ipca15.json": None, "/l/myselic.json": None, "/l/selic.json.bak": None, "/selic.json/x.json": None,
    }
    df = spark.createDataFrame([(n,) for n in names], "f string")
    assert {r.f: r.s for r in df.select("f", series_attribute("f", DEFAULT_SERIES, "name").alias("s")).collect()} == names


def test_file_that_two_series_match_is_an_error(spark):
    import dataclasses

    import pytest

    from ratelake.functions.series import series_attribute

    both = (DEFAULT_SERIES[0], dataclasses.replace(DEFAULT_SERIES[1], file_pattern="selic"))
    df = spark.createDataFrame([("/l/selic.json",)], "f string")
    with pytest.raises(Exception, match="several series match"):
        df.select(series_attribute("f", both, "name")).collect()

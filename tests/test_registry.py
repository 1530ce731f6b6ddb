"""Every registered query vs its DuckDB oracle (sf0.001), and the entry."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from ratelake.plans import registry  # noqa: E402
from check_oracles import duck, rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="benchmark tables absent")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and df.columns[:2] == ["year_month", "month_start"]


def test_every_query_has_an_oracle_or_is_listed():
    assert set(registry.QUERIES) == set(registry.ORACLES)
    assert registry.QUERIES.keys() <= E.queries().keys()


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    s_rows = [tuple(r) for r in sdf.collect()]
    res = con.execute(E.oracle_sql()[name])
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    assert sorted(sdf.columns) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert rows_of(sdf.columns, s_rows) == rows_of(d_cols, d_rows)


def test_query_names_follow_the_naming_rules():
    import re

    for name in registry.QUERIES:
        assert "pipeline" not in name and not re.match(r"op\d+_", name), name

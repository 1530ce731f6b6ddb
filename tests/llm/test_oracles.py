"""Corpus queries that SQL can express, against DuckDB; names and schemas of all."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracles import duck, rows_of  # noqa: E402
from ratelake.llm import queries  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="benchmark tables absent")


def test_every_operator_is_registered_once():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 1 + len(numbers)))
    assert set(queries.QUERIES) | {"pipeline"} <= set(E.queries())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_oracle(spark, name):
    frame = queries.QUERIES[name](spark, SF)
    res = duck(SF).execute(queries.ORACLES[name])
    cols, rows = [d[0] for d in res.description], res.fetchall()
    got = [tuple(r) for r in frame.collect()]
    assert sorted(frame.columns) == sorted(cols)
    assert rows_of(frame.columns, got) == rows_of(cols, rows)

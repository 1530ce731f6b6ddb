import numpy as np
import pytest

from ratelake.llm.ann import nearest

SCHEMA = "vec_id long, embedding array<float>, label int, tree int, score double"


def exact(rows, query, k):
    """Brute force over usable vectors, in double precision."""
    ok = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        ok.setdefault(i, []).append(np.array(v, np.float32).astype(np.float64))
    if query not in ok:
        return []
    best = {i: max(float(q @ v) for q in ok[query] for v in vs) for i, vs in ok.items() if i != query}
    return sorted(best.items(), key=lambda x: (-round(x[1], 12), x[0]))[:k]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 0.5) for i, v in rows], SCHEMA).repartition(3)


def test_recall_order_and_scores(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.standard_normal(16)]) for i in range(1500)]
    rows += [(2000 + i, rows[40][1]) for i in range(30)]  # equal vectors tie
    table = frame(spark, rows)
    got = nearest(table, table.where("vec_id % 20 = 0"), k=20, depth=4, block=300).collect()
    by = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        by.setdefault(r.query_id, []).append((r.vec_id, r.score))
    recall = []
    vectors = dict(rows)
    for q, found in by.items():
        want = exact(rows, q, 20)
        assert len(found) == 20 and q not in dict(found)
        assert found == sorted(found, key=lambda x: (-x[1], x[0]))
        for v, s in found:
            true = np.float64(np.array(vectors[q], np.float32)) @ np.float64(np.array(vectors[v], np.float32))
            assert s == pytest.approx(true, abs=1e-12)
        recall.append(len({v for v, _ in found} & {v for v, _ in want}) / 20)
    assert len(by) == sum(i % 20 == 0 for i, _ in rows) and np.mean(recall) >= 0.9


def test_ties_go_to_smaller_ids_and_own_row_is_left_out(spark):
    rows = [(i, [1.0, 0.0]) for i in range(60)]
    table = frame(spark, rows)
    got = nearest(table, table.where("vec_id = 20"), k=5, block=7).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [0, 1, 2, 3, 4] and [r["rank"] for r in got] == [1, 2, 3, 4, 5]


def test_awkward_rows(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, None), (2, [0.0, 0.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]),
            (5, [None, 1.0]), (6, [0.5, 0.5]), (None, [1.0, 1.0]), (7, [3.0]), (20, [0.0, 0.0]), (8, [1.0, 1.0])]
    table = frame(spark, rows)
    got = nearest(table, table.where("vec_id % 20 = 0"), k=20).orderBy("rank").collect()
    assert [(r.query_id, r.vec_id, r.score) for r in got] == [(0, 8, 3.0), (0, 6, 1.5)]
    assert nearest(table.where("false"), table, k=3).count() == 0
    assert nearest(table, table.where("false"), k=3).count() == 0


def test_an_id_of_many_vectors_leaves_room_for_others(spark):
    """20 other ids are found whenever there are 20, also where one id fills every leaf near the query."""
    rng = np.random.default_rng(3)
    query = rng.standard_normal(8)
    rows = [(0, [float(x) for x in query])]
    rows += [(7, [float(x) for x in 3 * query + 0.1 * rng.standard_normal(8)]) for _ in range(400)]
    rows += [(100 + i, [float(x) for x in rng.standard_normal(8)]) for i in range(300)]
    table = frame(spark, rows)
    got = nearest(table, table.where("vec_id = 0"), k=20, depth=3, block=64).orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 21)) and len({r.vec_id for r in got}) == 20
    want = exact(rows, 0, 20)
    assert got[0].vec_id == 7 and got[0].score == pytest.approx(want[0][1], abs=1e-12)
    assert len({r.vec_id for r in got} & {i for i, _ in want}) >= 18

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from ratelake.llm.prefix_trie import MessageQueue, prefix_trie

ROWS = "conv_id long, turn long, role string, text string, depth long, k1 string, len int, shard string"


def frame(spark, rows, parts=4):
    return spark.createDataFrame([(*r, 7, "x", None, "s") for r in rows], ROWS).repartition(parts)


def brute(rows):
    """Every node of the trie, by dictionaries of prefixes."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in turns.items()}
    paths = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        paths[c] = tuple(own.get(c - c % 20, [])[:h] + v[h:])
    members = defaultdict(list)
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
    children = defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        words = len(p[-1][1].translate({i: " " for i in range(9, 14)}).split(" ")) - p[-1][1].translate({i: " " for i in range(9, 14)}).split(" ").count("") if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(m) - 1) * words
    out = []
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(paths[c]) == len(p))))
        parent = min(members[p[:-1]]) if p else None
        out.append((min(m), len(p), parent, len(m), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(map(str, out))


def check(spark, rows, **kwargs):
    got = prefix_trie(frame(spark, rows), **kwargs).collect()
    cols = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    assert sorted(str(tuple(r[c] for c in cols)) for r in got) == brute(rows)


def conversations(n, seed):
    rng = random.Random(seed)
    says = ["hi there", "Hi there", "how are you", "", None, "a\tb  c\n", "é ü"]
    rows = []
    for c in range(n):
        if rng.random() < 0.1:
            continue  # some bases are absent
        for t in range(rng.choice([1, 1, 2, 3, 4, 6])):
            rows.append((c, rng.choice([t, t, None]), rng.choice(["user", "bot", None]), says[min(6, int(rng.expovariate(0.7)))]))
    return rows + rows[:5]  # repeated rows are as many turns


def test_nodes_against_dictionaries(spark):
    rows = conversations(90, 1) + [(None, 1, "user", "nobody's")] + [(20 * i, 1, "user", "one") for i in range(100, 130)]
    check(spark, rows)
    check(spark, rows, shard_rows=6, queue_limit=2)  # many rounds, a queue on disk


def test_long_and_frequent_conversations(spark):
    long = [(7, t, "user", f"turn {t % 3}") for t in range(200)]
    same = [(1000 + c, t, "user", "the same words") for c in range(300) for t in range(2)]
    check(spark, long + same + conversations(30, 2), shard_rows=40, queue_limit=10)


def test_turnless_and_empty(spark):
    # conversation 3 has fewer turns than it replaces and no base: rebuilt without turns
    heads = {c: zlib.crc32(str(c).encode()) % 4 for c in range(1, 20)}
    rows = [(c, 0, "user", "x") for c, h in heads.items() if h >= 1]
    assert rows
    check(spark, rows)
    assert prefix_trie(frame(spark, rows).where("false")).count() == 0
    with_long_text = [(40, 0, "user", "word " * 200_000), (41, 0, None, None)]
    check(spark, with_long_text)


def test_partitions_number_a_spread_conversation(spark):
    rows = [(5, t, "user", str(t)) for t in range(250)] + [(c, 0, "user", "0") for c in (1, 2, 9)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        check(spark, rows, shard_rows=10_000)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("limit", [1, 3, 50, 10_000])
def test_queue_gives_messages_in_order(limit):
    rng = random.Random(limit)
    queue, sent = MessageQueue(limit), []
    for i in range(400):
        m = ((rng.randrange(60), rng.randrange(3), 0), i, 0)
        queue.push(m)
        sent.append(m)
    got = []
    for place in sorted({m[0] for m in sent}):
        here = list(queue.take(place))
        assert {m[0] for m in here} == {place}
        got += here
        queue.push(((99, 0, place[0]), 0, 0))
    assert sorted(got) == sorted(sent)
    assert not queue.heap or queue.heap[0][0][0] == 99

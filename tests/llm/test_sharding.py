import zlib
from collections import defaultdict

import numpy as np

from llm_helpers import docs
from ratelake.llm.sharding import jump_hash, shard_documents, with_shard


def one_key(key, n):
    """Jump hash of one key with Python integers."""
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2.0**31 / ((key >> 33) + 1)))
    return b


def test_jump_hash_against_one_key_at_a_time():
    keys = np.concatenate([np.arange(300, dtype=np.uint64), np.array([2**63, 2**64 - 1, 2**40 + 7], np.uint64)]).astype(np.uint64)
    for n in (1, 2, 40, 41, 1000):
        assert jump_hash(keys, n).tolist() == [one_key(int(k), n) for k in keys]


def test_slots_sizes_and_growth(spark):
    rows = [(i, f"text é {i}" * (i % 7)) for i in range(900)] + [(None, None), (5, ""), (5, ""), (5, "x" * 300_000)]
    rows += [(77, "same")] * 50
    got = shard_documents(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    slots = defaultdict(list)
    by_id = defaultdict(set)
    for r in got:
        slots[r.shard].append(r.slot)
        by_id[r.doc_id].add((r.shard, r.grown_shard))
        assert r.law == "key" and 0 <= r.shard < 40 and r.grown_shard in (r.shard, 40)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(v) == 1 for v in by_id.values())
    want = sorted((str(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == want
    moved = sum(r.grown_shard == 40 for r in got)
    assert 0 < moved < len(got) / 10


def test_empty_table_and_other_keys(spark):
    assert shard_documents(docs(spark, [(1, "x")]).where("false")).count() == 0
    frame = with_shard(docs(spark, [(1, "a"), (2, "a"), (3, None)]), "text", 8, "at")
    assert {r.text: r["at"] for r in frame.collect()}.keys() == {"a", None} and "shard" in frame.columns

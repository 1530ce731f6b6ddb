import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from llm_helpers import docs, sentence
from ratelake.llm.packing import differencing, pack_block, pack_documents

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_differencing_is_a_partition_and_near_equal():
    rng = random.Random(3)
    for n, k in ((1, 1), (3, 5), (50, 7), (400, 16), (7, 7)):
        sizes = [rng.randint(1, 512) for _ in range(n)]
        windows = differencing(sizes, k)
        assert sorted(i for w in windows for i in w) == list(range(n)) and len(windows) <= k
        if n >= 20 * k:
            sums = [sum(sizes[i] for i in w) for w in windows]
            assert max(sums) - min(sums) <= 0.02 * max(sums)


def test_windows_rise_with_capacity():
    windows = pack_block([600, 600, 600], 1000)  # two windows would hold the sum, not the items
    assert sorted(map(len, windows)) == [1, 1, 1]
    assert pack_block([], 10) == [] and len(pack_block([1] * 5000, 2048)) == 3
    with pytest.raises(ValueError):
        pack_block([11], 10)


def test_round_trip(spark):
    odd = "Hi <|endoftext|> there, don't!!  \t ΟΔΥΣΣΕΥΣ İstanbul é ́x 東京  nb sp \x1c y 12.5% 😀😀 ﬁne\r\nline"
    rows = [(i, sentence(i, 5 + 37 * (i % 40))) for i in range(300)]
    rows += [(500, None), (501, ""), (502, odd), (502, odd), (None, "null id"), (503, sentence("long", 30_000)), (2**60 + 1, "big id")]
    table = docs(spark, rows)
    got = pack_documents(table, PATH, block_windows=8).collect()
    tokenizer = Tokenizer.from_file(PATH)
    pieces = defaultdict(list)
    sequences = defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        own.sort()
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:])) and sum(own[-1]) <= 2048
    texts = defaultdict(list)
    for i, t in rows:
        texts[i].append(t)
    assert set(pieces) == set(texts)
    for i, own in texts.items():
        ids = np.array(tokenizer.encode(own[0] or "", add_special_tokens=False).ids + [1], "<u4")
        cuts = sorted((r.start, r.length) for r in pieces[i])
        assert cuts[0][0] == 0 and sum(n for _, n in cuts) == len(own) * len(ids)
        for r in pieces[i]:
            assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    tokens = sum(r.length for r in got)
    assert tokens / (2048 * len(sequences)) > 0.9


def test_little_memory_gives_the_same_rows(spark):
    rows = [(i, sentence(i, 5 + 37 * (i % 40))) for i in range(200)] + [(500, None), (501, ""), (None, "null id"), (503, sentence("long", 9_000))]
    table = docs(spark, rows)
    few = pack_documents(table, PATH, cache_bytes=2_000, slice_bytes=500).collect()
    assert few == pack_documents(table, PATH).collect()


def test_pipeline_packs_with_less_memory(spark, monkeypatch):
    """Executors keep what the four stages before have taken; a worker's cache may not come on top of it in full."""
    import corpus_pipeline
    from ratelake.llm import packing

    asked = {}
    pack = packing.pack_documents
    monkeypatch.setattr(packing, "pack_documents", lambda *a, **b: asked.update(b) or pack(*a, **b))
    table = docs(spark, [(i, sentence(i, 60)) for i in range(50)])
    assert corpus_pipeline.pack(spark, table, "").collect() == pack(table, PATH).collect()
    assert asked["cache_bytes"] <= packing.CACHE_BYTES // 3 and asked["slice_bytes"] <= packing.SLICE_BYTES // 4


def test_empty_table(spark):
    assert pack_documents(docs(spark, [(1, "x")]).where("false"), PATH).count() == 0


def test_cache_is_bounded_and_unspaced_texts_are_whole(spark):
    import pyarrow as pa

    from ratelake.llm.packing import WordCache

    plain = Tokenizer.from_file(PATH)
    odd = ["İstanbul Straße, naïve été! I'd we'll ... a=b ﬁne", "x" * 500_000 + "。" + "漢字" * 1000, "", None, "one. One, ONE; one"]
    texts = odd + [sentence(i, 300) for i in range(40)] + odd
    for limit in (2_000, 192_000_000):  # the first forgets nearly everything
        cache = WordCache(PATH, limit)
        ids, ends = cache.ids(pa.array(texts), 1)
        want = [plain.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]
        assert [x.tolist() for x in np.split(ids, ends[:-1])] == want
        assert cache.used <= limit + 600 and all(len(p) <= 64 for p in cache.young)
    big = "y" * 5_000_000
    n = len(plain.encode(big, add_special_tokens=False).ids) + 1
    got = pack_documents(docs(spark, [(1, big), (2, "short")]), PATH).where("doc_id = 1").collect()
    assert sum(r.length for r in got) == n and {r.doc_tokens for r in got} == {n}

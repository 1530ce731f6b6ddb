import random

import numpy as np
import pytest
import xxhash

from llm_helpers import docs, sentence
from ratelake.llm import simhash


def plain_simhash(text):
    """The definition, bit by bit."""
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in (text or "")).translate({i: " " for i in range(9, 14)}).split(" ") if w]
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(values, bits=4):
    """Least index of each value's component, all pairs compared."""
    parent = list(range(len(values)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if bin(values[i] ^ values[j]).count("1") <= bits:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [root(i) for i in range(len(values))]


def test_fingerprint_against_the_definition():
    texts = ["", None, " \t\n", "One", "one two THREE", "a b c d", "É é ß A B c d e", sentence(1, 5000), "x" * 3_000_000, "a\x0bb\x0cc\rd\te"]
    texts += [sentence(i, n) for i, n in enumerate((3, 4, 5, 17, 400))]
    for t in texts:
        data = None if t is None else t.encode()
        assert simhash.simhash(data) == plain_simhash(t)
    long = (sentence(2, 900) + " ") * 40
    old = simhash.word_runs.__defaults__
    simhash.word_runs.__defaults__ = (1000,)  # many runs: shingles across their ends count too
    try:
        assert simhash.simhash(long.encode()) == plain_simhash(long)
    finally:
        simhash.word_runs.__defaults__ = old


def test_components_against_all_pairs(spark):
    rows = [(i, sentence(i % 7, 30 + i % 7)) for i in range(20)]
    for i in range(40):
        w = sentence(("near", i % 8), 160).split()
        for _ in range(i // 8):
            w[random.Random(i).randrange(len(w))] = "edit"
        rows.append((100 + i, " ".join(w)))
    rows += [(300, None), (301, ""), (302, " \n"), (303, "word"), (303, "word"), (None, "word"), (None, "lonely"), (304, sentence("long", 40_000))]
    got = simhash.near_duplicates(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    values = [plain_simhash(t) for _, t in rows]
    roots = brute(values)
    want = []
    for (i, _), v, r in zip(rows, values, roots):
        members = [rows[k][0] for k in range(len(rows)) if roots[k] == r]
        want.append((str(i), f"{v:016x}", str(min((m for m in members if m is not None), default=None)), len(members)))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id), r.n_component) for r in got) == sorted(want)
    assert simhash.near_duplicates(docs(spark, []) if rows is None else docs(spark, rows).where("false")).count() == 0


@pytest.mark.parametrize("bits,longest", [(4, 64), (4, 2), (4, 0), (2, 1), (6, 64)])
def test_links_in_dense_and_long_lists(spark, bits, longest):
    """A ball of fingerprints around a few centres: long lists must lose no component."""
    rng = random.Random(bits * 100 + longest)
    values = set()
    for _ in range(4):
        centre = rng.getrandbits(64)
        for _ in range(18 if longest else 8):
            v = centre
            for b in rng.sample(range(64), rng.randint(0, bits + 2)):
                v ^= 1 << b
            values.add(v)
    chain = rng.getrandbits(64)  # each step the most allowed
    for i in range(6):
        values.add(chain)
        for b in range(bits):
            chain ^= 1 << (i * bits + b) % 64
    values |= {0, 2**64 - 1, 2**63, *(rng.getrandbits(64) for _ in range(30))}
    values = sorted(values)
    signed = [(int(np.uint64(v).view(np.int64)),) for v in values]
    found = simhash.links(spark.createDataFrame(signed, "fp long"), bits, longest).collect()
    at = {s[0]: i for i, s in enumerate(signed)}
    edges = [(at[r.a], at[r.b]) for r in found]
    near = lambda i, j, d: bin(values[i] ^ values[j]).count("1") <= d
    assert all(near(i, j, bits) for i, j in edges)
    parent = list(range(len(values)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in edges:
        a, b = sorted((root(i), root(j)))
        parent[b] = a
    assert [root(i) for i in range(len(values))] == brute(values, bits)
    if longest == 64:  # all lists short: every pair within the bits, once
        assert len(edges) == len(set(edges)) == sum(near(i, j, bits) for i in range(len(values)) for j in range(i))


def test_bits_of_a_wrong_number_are_refused(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.range(2).withColumnRenamed("id", "fp"), 3)

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from llm_helpers import docs
from ratelake.llm import collocations as C


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def pieces(text):
    return [re.findall(r"[^ \t]+", p) for p in re.split("[.,;:!?\n\x0b\x0c\r]", lower(text or ""))]


def counts(texts):
    f = Counter()
    for text in texts:
        for w in pieces(text):
            for k in range(1, 5):
                f.update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    return f


def brute(rows, least, top):
    by = defaultdict(list)
    for _, text, lang in rows:
        by["und" if lang is None else lang].append(text)
    out = []
    for lang, texts in by.items():
        f = counts(texts)
        n = sum(c for w, c in f.items() if len(w) == 1)
        cand = {w: a for w, a in f.items() if len(w) > 1 and a >= least}
        scored = []
        for w, a in cand.items():
            if any(len(v) > len(w) and 100 * b >= 80 * a and any(v[i : i + len(w)] == w for i in range(len(v))) for v, b in cand.items()):
                continue
            score, _, l, r = min((2_000_000 * a // (f[w[:k]] + f[w[k:]]), k, f[w[:k]], f[w[k:]]) for k in range(1, len(w)))
            scored.append((-score, -a, " ".join(w).encode(), l, r))
        out += [(lang, i + 1, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(scored)[:top])]
    return sorted(out)


def corpus(n, seed):
    rng = random.Random(seed)
    vocabulary = ["new", "York", "city", "of", "The", "é", "\x01a", "a", "über", "x-y", "don't", "12", "a\x02"]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randint(0, 60)):
            words += rng.choice([["new", "york", "city"], ["the", "city"], ["of", "the"]]) if rng.random() < 0.5 else [rng.choice(vocabulary)]
            words.append(rng.choice([" ", " ", "\t", "  ", ". ", "\n", ",", "!?", " ; "]))
        rows.append((i, " ".join(words) if i % 3 else "".join(w if w[0] in " \t.\n,!;" else w + " " for w in words), rng.choice(["en", "fr", None, "und"])))
    return rows + [(1, None, "en"), (2, "", "xx"), (3, " .,", "yy"), (None, "new york new york", "en"), (4, "same same same", "en")] * 3


@pytest.mark.parametrize("options", [{}, {"shard_words": 50, "block_rows": 7, "range_rows": 40, "fan_in": 3, "buckets": 3}])
def test_phrases_against_all_counts(spark, options):
    rows = corpus(120, 5)
    got = C.collocations(docs(spark, rows), least=6, top=25, **options).collect()
    cols = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    assert sorted(tuple(r[c] for c in cols) for r in got) == brute(rows, 6, 25)


def test_tiny_tables(spark):
    assert C.collocations(docs(spark, []) if False else docs(spark, corpus(1, 0)).where("false")).count() == 0
    assert C.collocations(docs(spark, [(1, "too few words", "en"), (2, None, None)])).count() == 0
    long = "word " * 300_000 + "end"
    got = C.collocations(docs(spark, [(1, long, "en"), (2, "z" * 2_000_000, "en")])).collect()
    assert sorted(tuple(r) for r in got) == brute([(1, long, "en"), (2, "z" * 2_000_000, "en")], 30, 2000)


def random_sequences(rng, n, words):
    rows = np.zeros((n, 4), np.int32)
    for i in range(n):
        k = rng.integers(1, 5)
        rows[i, :k] = rng.integers(1, words + 1, k)
    return rows


def test_automaton_round_trip_union_and_cut():
    rng = np.random.default_rng(1)
    names = sorted((bytes(rng.integers(97, 100, rng.integers(1, 5)).astype(np.uint8)) for _ in range(60)), key=lambda w: w + b"\t")
    names = sorted(set(names) | {b"a\x01", b"a"}, key=lambda w: w + b"\t")
    total, parts = Counter(), []
    for n in (1, 2, 40, 500):
        rows = random_sequences(rng, n, len(names))
        a = C.Automaton.of(names, rows, np.ones(n, np.int64))
        back = C.Automaton.load(a.dump())
        assert back.words == a.words and (back.rows == a.rows).all() and (back.weights == a.weights).all()
        keys = [a.key(i) for i in range(len(a.rows))]
        assert keys == sorted(keys) and len(set(keys)) == len(keys)
        mid = len(a.rows) // 2
        for some in (a.part(0, mid), a.part(mid, len(a.rows))):
            if len(some.rows):
                some = C.Automaton.load(some.dump())
                parts.append(some)
                for row, w in zip(some.rows.tolist(), some.weights.tolist()):
                    total[tuple(some.words[i - 1] for i in row if i)] += w
    whole = C.Automaton.union(parts)
    got = {tuple(whole.words[i - 1] for i in row if i): w for row, w in zip(whole.rows.tolist(), whole.weights.tolist())}
    assert got == dict(total)
    sums = Counter()
    for seq, w in total.items():
        for k in range(1, len(seq) + 1):
            sums[" ".join(x.decode() for x in seq[:k])] += w
    assert {p: f for p, _, f in whole.prefixes(0)} == dict(sums)


def test_exact_beyond_64_bits(spark):
    """2000000 * a passes 64 bits: counts as large as that come from a table of counts."""
    from pyspark.sql import functions as F

    a, l, r = 9 * 10**17, 9 * 10**17 + 1, 9 * 10**17 + 5
    frame = spark.createDataFrame([(a, l, r)], "a long, l long, r long")
    assert frame.select(C.score("a", "l", "r").alias("s"), F.lit(0)).first()[0] == 2_000_000 * a // (l + r)

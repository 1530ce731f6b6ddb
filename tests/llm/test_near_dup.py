import random

import numpy as np

from llm_helpers import docs, sentence
from ratelake.llm.near_dup import aligned, components, near_duplicates, shingles


def lcs(a, b):
    """Plain dynamic programme, no band."""
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def similarity(a, b):
    x, y = shingles(a or "").tolist(), shingles(b or "").tolist()
    if not x or not y:
        return 0.0
    m = lcs(x, y)
    return m / (len(x) + len(y) - m)


def edited(text, edits, seed):
    rng = random.Random(str(seed))
    w = text.split()
    for _ in range(edits):
        at = rng.randrange(len(w))
        action = rng.randrange(3)
        if action == 0:
            w[at] = "edit" + str(rng.randrange(99))
        elif action == 1:
            w.insert(at, "more")
        elif len(w) > 2:
            del w[at]
    return " ".join(w)


def brute_classes(rows):
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(rows):
        for j in range(i):
            b = rows[j][1]
            if a is not None and b is not None and (a == b or similarity(a, b) >= 0.8):
                parent[root(i)] = root(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(root(i), []).append(i)
    return {frozenset(g) for g in groups.values()}


def classes(spark, rows):
    got = near_duplicates(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    out = {}
    for r in got:
        out.setdefault(r.class_id, []).append(r.doc_id)
    for r in got:
        assert r.n_class == len(out[r.class_id]) and r.class_id == min(out[r.class_id])
    return {frozenset(g) for g in out.values()}


def test_alignment_against_plain_dynamic_programme():
    rng = random.Random(0)
    for n in (1, 4, 9, 40, 150):
        a = sentence(n, n, words=5)
        for e in (0, 1, 2, n // 12, n // 3):
            b = edited(a, e, rng.random())
            want = similarity(a, b)
            got = aligned(shingles(a), shingles(b), 0.8)
            assert (got == want) if want >= 0.8 else got < 0.8
    moved = " ".join(sentence(1, 200).split()[100:] + sentence(1, 200).split()[:100])
    assert aligned(shingles(sentence(1, 200)), shingles(moved), 0.8) < 0.8  # the order counts


def test_classes_against_all_pairs(spark):
    rows = []
    for g in range(14):
        base = sentence(g, [6, 7, 9, 12, 25, 36, 45, 60, 100, 150, 200, 260, 300, 30][g])
        size = len(base.split())
        rows += [base] + [edited(base, max(1, size // 40), (g, k)) for k in range(4)] + [edited(base, size // 6, (g, 9))]
    passage = sentence("shared", 60)
    rows += [f"{sentence(('own', i), 25)} {passage}" for i in range(12)] + [sentence(("alone", i), 80) for i in range(10)]
    rows += ["", "", "one", "one", "One!", "two words", "a b c d", "a b c d e", " . ", "x" * 100_000]
    rows = list(enumerate(rows))
    want = {frozenset(g) for g in brute_classes(rows)}
    assert classes(spark, rows) == want


def test_star_around_an_original_and_large_group(spark):
    base = sentence("large", 120)
    rows = [(i, edited(base, 2, i)) for i in range(1, 150)] + [(0, base)] + [(1000 + i, base) for i in range(80)]
    assert classes(spark, rows) == {frozenset(i for i, _ in rows)}


def test_nulls_and_repeats(spark):
    long = sentence(5, 30_000)
    rows = [(1, None), (2, None), (None, None), (None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (4, long), (5, long + " end")]
    got = near_duplicates(docs(spark, rows)).collect()
    assert sorted((str(r.doc_id), str(r.class_id), r.n_class) for r in got) == sorted(
        [("1", "1", 1), ("2", "2", 1), ("None", "None", 1), ("None", "3", 3), ("3", "3", 3), ("3", "3", 3), ("4", "4", 2), ("5", "4", 2)]
    )
    assert near_duplicates(docs(spark, rows).where("false")).count() == 0


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, 101 + i) for i in range(30)]
    frame = spark.createDataFrame(chain + star + [(7, 7)], "a long, b long")
    got = {r.node: r.comp for r in components(frame).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {101 + i: 100 for i in range(30)}
    assert np.all([v < k for k, v in got.items()])


def test_group_of_near_copies_just_below_the_threshold(spark):
    """3,000 texts near one original, most of them too far from each other: only linked ones are met across classes."""
    base = sentence("hot", 120)
    rows = [(0, base)] + [(i, edited(base, 2 if i % 30 == 0 else 5, ("hot", i))) for i in range(1, 3000)]
    got = near_duplicates(docs(spark, rows)).collect()
    assert len(got) == 3000
    # against brute force over the shingle sets of a part, the links to the original among them
    near = {i for i, t in rows if similarity_of_sets(base, t) >= 0.8 and aligned(shingles(base), shingles(t), 0.8) >= 0.8}
    assert {r.doc_id for r in got if r.class_id == 0} >= near
    by_class = {}
    for r in got:
        by_class.setdefault(r.class_id, []).append(r.doc_id)
    texts = dict(rows)
    for c, members in by_class.items():
        for m in members[1:3]:  # every member is linked to some other of its class
            assert any(o != m and similarity_of_sets(texts[m], texts[o]) >= 0.8 for o in members)


def similarity_of_sets(a, b):
    x, y = shingles(a), shingles(b)
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both)

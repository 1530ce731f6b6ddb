import hashlib
import io
import re
from contextlib import redirect_stdout

from llm_helpers import docs, sentence
from ratelake.llm.decontam import build_index, contamination, phrase_matches, proximity_matches, test_words as item_words

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(doc, items, window=10):
    w = words(doc)
    hit, ids = set(), set()
    for item_id, text in items:
        v = words(text)
        if not v:
            continue
        n = min(window, len(v))
        grams = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)}
        for s in range(len(w) - n + 1):
            if tuple(w[s : s + n]) in grams:
                hit.update(range(s, s + n))
                ids.add("" if item_id is None else str(item_id))
    joined = ",".join(sorted(ids))
    return len(w), len(hit), len(ids), hashlib.sha256(joined.encode()).hexdigest(), bool(hit)


def check(spark, rows, items):
    table = spark.createDataFrame(items, "item_id long, text string")
    got = contamination(docs(spark, rows), table).collect()
    got = sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got)
    assert got == sorted((str(i), *brute(t, items)) for i, t in rows)


def test_against_brute_force(spark):
    a, b = sentence(1, 40), sentence(2, 14)
    common = "the of and the of and the of and the of and"
    items = [(1, a), (2, b.upper()), (10, "Déjà vu"), (11, "solo"), (12, common), (13, ""), (14, None), (1, a), (None, sentence(3, 11)), (2, "x y z")]
    part = " ".join(a.split()[5:17])
    rows = [
        (1, f"{sentence(9, 30)} {a}, {sentence(8, 5)}"), (2, f"Vor {part.title()} nach."), (3, " ".join(a.split()[:9])),
        (4, b + " " + b), (5, "DéJà-VU déjà! vu solo"), (6, "dÉjà vu SOLO."), (7, None), (8, ""), (9, common * 4 + " " + common),
        (10, sentence(3, 11).replace(" ", "\n")), (10, "x, y; z"), (10, "x, y; z"), (None, "solo"), (11, "sölo so lo 😀 solo😀"),
        (12, (sentence(4, 3000) + " ") * 6 + part), (13, " ".join(reversed(a.split()))),
    ]
    check(spark, rows, items)


def test_short_windows_and_repeated_rows(spark):
    """Windows of one, two and three words have no or one other word to ask for."""
    items = [(1, "solo"), (2, "uno due"), (3, "uno uno"), (4, "uno due tre"), (5, "nirgends"), (6, "nirgends due"), (7, "due uno due")]
    rows = [(1, "solo uno due tre"), (1, "solo uno due tre"), (2, "due uno uno due"), (3, "tre due uno"), (4, "solo solo"), (5, "uno"), (6, "due uno due uno due")]
    check(spark, rows, items)
    check(spark, rows, items[4:5])


def test_postings_are_shuffled_once(spark):
    """One shuffle of the postings serves the second and all other words."""
    text = sentence(1, 30)
    table = docs(spark, [(i, f"{sentence(100 + i, 20)} {text if i % 3 else text[:90]}") for i in range(40)])
    vocabulary, windows = item_words(spark.createDataFrame([(1, text)], "item_id long, text string"), 10)
    index = build_index(table, vocabulary)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        found = phrase_matches(index, vocabulary, windows)
        assert {r.doc for r in found.collect()} == set(range(40))
        plan = io.StringIO()
        with redirect_stdout(plan):
            found.explain("formatted")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    tree = plan.getvalue().split("Initial Plan")[0]  # as it ran
    tree = [line for line in tree.splitlines() if re.match(r"[ :+*|-]*(SortMergeJoin LeftSemi|ReusedExchange) \(", line)]
    assert sorted(line.strip(" :+*|-").split(" (")[0] for line in tree) == ["ReusedExchange", "SortMergeJoin LeftSemi", "SortMergeJoin LeftSemi"]


def test_empty_tables(spark):
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert contamination(docs(spark, [(1, "a b c")]).where("false"), items).count() == 0
    row = contamination(docs(spark, [(1, "a b c")]), items.where("false")).first()
    assert (row.n_words, row.n_hit, row.contaminated) == (3, 0, False)


def test_proximity(spark):
    rows = [(1, "alpha x beta x x gamma"), (2, "gamma beta q alpha"), (3, "alpha " + "x " * 30 + "beta gamma"), (4, "alpha beta")]
    phrases = spark.createDataFrame([(7, "alpha beta gamma"), (8, "beta")], "phrase_id long, text string")
    vocabulary, windows = item_words(phrases.withColumnRenamed("phrase_id", "item_id"), 10)
    index = build_index(docs(spark, rows), vocabulary)
    got = {(r.doc, r.phrase_id) for r in proximity_matches(index, vocabulary, phrases, 6).collect()}
    assert got == {(1, 7), (2, 7), (1, 8), (2, 8), (3, 8), (4, 8)}
    assert {(r.doc, r.item_id) for r in phrase_matches(index, vocabulary, windows).collect()} == {(i, "8") for i in (1, 2, 3, 4)}

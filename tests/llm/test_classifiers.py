"""Language id and quality: held-out accuracy on the benchmark tables, awkward rows."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_helpers import docs, sentence
from ratelake.llm import langid, quality, queries

SF = "/root/testdata/sf0.01"
here = pytest.mark.skipif(not os.path.isdir(SF), reason="benchmark tables absent")


@here
def test_language_held_out_accuracy(spark):
    got = queries.op8_hyperdimensional(spark, SF)
    truth = spark.read.parquet(f"{SF}/documents.parquet")
    assert got.count() == truth.count()
    both = got.where("held_out").join(truth, "doc_id")
    assert both.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.98
    assert got.where("score < 0 or score > 1 or score is null or lang_pred is null").count() == 0


def test_language_awkward_rows(spark):
    rows = [(i, "the cat and the dog " * 5, "en") for i in range(3)] + [(10 + i, "der hund und die katze " * 5, "de") for i in range(3)]
    learned = langid.train(docs(spark, rows + [(20, None, "en"), (21, "x y", None), (22, "123", "fr")]))
    assert list(learned) == ["de", "en"]  # nothing can be learned of fr from digits
    asked = [(1, "the THE and!"), (2, None), (3, ""), (4, "123 !!"), (5, "und die"), (None, "the cat"), (6, "the dog " * 60_000), (5, "und die"), (7, "t")]
    got = langid.identify(spark, docs(spark, asked), learned).collect()
    assert sorted((str(r.doc_id), r.lang_pred) for r in got if r.doc_id != 7) == sorted(
        [("1", "en"), ("2", "und"), ("3", "und"), ("4", "und"), ("5", "de"), ("5", "de"), ("None", "en"), ("6", "en")]
    )
    assert all((r.score == 0) == (r.lang_pred == "und") and 0 <= r.score <= 1 for r in got)
    assert langid.identify(spark, docs(spark, asked).where("false"), learned).count() == 0
    assert {r.lang_pred for r in langid.identify(spark, docs(spark, asked), {}).collect()} == {"und"}


def test_bundle_is_the_sum_of_bound_vectors():
    import numpy as np

    space = langid.Space(64, 3)
    a, b, blank = (space.letter(ord(c)).astype(int) for c in "ab ")
    bind = lambda x, y, z: np.roll(x, 2) * np.roll(y, 1) * z
    want = bind(blank, a, b) + bind(a, b, blank)
    assert (langid.bundle(["AB", "12"], space) == np.stack([want, 0 * want])).all()


@here
def test_quality_held_out_accuracy(spark):
    got = queries.op9_lsa_neighbours(spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    both = got.where("held_out").join(labels, "doc_id")
    right = {r["quality"]: r["share"] for r in both.groupBy("quality").agg(F.avg((F.col("quality") == F.col("predicted")).cast("double")).alias("share")).collect()}
    assert right[1] > 0.97 and right[0] > 0.85
    assert got.where("score is null or score < 0 or score > 1 or predicted <> cast(score >= 0.7 as int)").count() == 0


def test_quality_awkward_rows(spark):
    good = [(i, sentence(i, 60).capitalize() + ".") for i in range(12)]
    bad = [(100 + i, " ".join(w.upper() + "!!" for w in sentence(i, 60).split())) for i in range(12)]
    table = docs(spark, good + bad + [(300, None), (301, "x")])
    marks = [(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in bad] + [(0, 1, 0), (300, 1, 0), (301, None, 1), (999, 1, 0), (None, 0, 0)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    model = quality.fit(quality.labelled_sample(table, labels, F.lit(True)))
    score = quality.scorer(spark, model)
    asked = docs(spark, [(1, sentence("new", 50) + "."), (2, sentence("new", 50).upper().replace(" ", "!! ")), (3, None), (4, ""), (None, " "), (5, "é" * 200_000)])
    got = {str(r.doc_id): r["s"] for r in asked.select("doc_id", score("text").alias("s")).collect()}
    assert got["1"] > 0.7 > 0.3 > got["2"] and got["3"] == got["4"] and all(0 <= v <= 1 for v in got.values())
    none = quality.scorer(spark, quality.fit(quality.labelled_sample(table, labels.where("false"), F.lit(True))))
    assert {r[0] for r in asked.select(none("text")).collect()} == {0.5}
    assert asked.where("false").select(score("text")).count() == 0


def test_quality_sample_is_bounded(spark):
    table = docs(spark, [(i, f"text {i}") for i in range(500)] + [(7, "text again")] * 300)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(600)] + [(9, 0, 0)], "doc_id long, quality int, toxic int")
    sample = quality.labelled_sample(table, labels, F.col("doc_id") % 4 != 2, per_class=40)
    rows = sample.collect()
    assert sum(r.label for r in rows) == 40 and len(rows) == 80 and all(r.doc_id % 4 != 2 for r in rows)
    assert len(quality.fit(sample).labels) == 80


def test_quality_counts_every_character_of_an_unspaced_text():
    clean, junk = "汉字" * 500, "汉字" * 100 + "###$$$%%%!!!" * 60
    shapes = [quality.raw_features(t)[: quality.SHAPES] for t in (clean, junk)]
    assert shapes[0].sum() < shapes[1].sum()  # junk after the first characters counts
    long = "Ab1-" * 500_000  # linear, one piece of the squeezed shape after the other
    assert quality.raw_features(long)[: quality.SHAPES].sum() == 500_000 * 4 / quality.PIECE + np.float32(0.2)
    # no long token stays in the caches
    assert all(len(t) <= quality.CACHED for t in [*quality._SQUEEZED, *(t for _, t in quality._SLOTS)])
    ends = ["，。？"[i % 3] for i in range(40)]
    good = ["".join("汉" * (3 + (i + k) % 5) + ends[(i + k) % 40] for k in range(60)) for i in range(20)]
    bad = [g[:40] + "###$$$%%%!!!" * 20 for g in good]
    model = quality.Model(np.stack([quality.raw_features(t) for t in good[2:] + bad[2:]]), [1] * 18 + [0] * 18)
    score = model.score([good[0], bad[0], good[1], bad[1]])
    assert min(score[0], score[2]) > 0.7 > 0.3 > max(score[1], score[3])


def test_prediction_against_plain_cosines(spark):
    """Every document's trigrams bound, bundled and compared with every prototype, one by one."""
    languages = {"aa": "abcde fgh", "bb": "bcxyz wvq", "cc": "mnopq é abc"}
    rows = [(i, " ".join(w[i % 3 :] + w for w in text.split()) * (1 + i % 4), lang) for lang, text in languages.items() for i in range(6)]
    learned = langid.train(docs(spark, rows), dim=128, seed=4)
    space = langid.Space(128, 4)

    def plain(text):
        x, t = np.zeros(128), " " + " ".join("".join(c.lower() if c.isalpha() else " " for c in text).split()) + " "
        for a, b, c in zip(t, t[1:], t[2:]) if t.strip() else ():
            x += np.roll(space.letter(ord(a)).astype(float), 2) * np.roll(space.letter(ord(b)), 1) * space.letter(ord(c))
        return x

    for lang in languages:
        assert np.allclose(learned[lang], sum(plain(t) for _, t, own in rows if own == lang))
    asked = [(i, t) for i, t in enumerate(["abc", "xyz wv", "mno é", "fgh!", "a", "Q q", "abcde mnopq", "12"])]
    got = {r.doc_id: r for r in langid.identify(spark, docs(spark, asked), learned, dim=128, seed=4).collect()}
    for i, t in asked:
        x = plain(t)
        if not x.any():
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
            continue
        cos = {lang: x @ p / np.linalg.norm(x) / np.linalg.norm(p) for lang, p in learned.items()}
        best = max(sorted(cos), key=cos.get)
        assert got[i].lang_pred == best and abs(got[i].score - max(0, cos[best])) < 1e-5


def test_vote_against_plain_cosines(spark):
    """The nearest of all labelled vectors found and weighted one by one."""
    sample = [(i, sentence(("q", i % 9), 30) if i % 2 else "###$$ 123 !! " * (1 + i), i % 2) for i in range(40)]
    model = quality.Model(np.stack([quality.raw_features(t) for _, t, _ in sample]), [x for _, _, x in sample], dims=8, neighbours=7)
    asked = ["", "a few words", "### 12 !!", sentence(("q", 3), 12), sentence("new", 300), "x" * 500] + [t for _, t, _ in sample[:5]]
    for block in (3, 1024):
        got = model.score(asked, block=block)
        for t, score in zip(asked, got):
            v = quality._weighted(quality.raw_features(t)[None, :], model.idf)[0] @ model.basis
            v = v / (np.linalg.norm(v) or 1)
            near = sorted(((float(v @ w), y) for w, y in zip(model.vectors, model.labels)), reverse=True)
            weights = [(max(0.0, c) ** 8, y) for c, y in near[:7]]
            total = sum(w for w, _ in weights)
            want = sum(w * y for w, y in weights) / total if total > 0 else 0.5
            ties = abs(near[6][0] - near[7][0]) < 1e-6  # the choice among equal cosines is free
            assert ties or abs(score - want) < 1e-4

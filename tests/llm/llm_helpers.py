"""Small documents tables with awkward rows and clashing extra columns."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, score double, h long, start int, n int, shard string"


def docs(spark, rows):
    """rows: (doc_id, text[, lang[, source]]); the extra columns' names clash with those used inside."""
    full = []
    for doc_id, text, *rest in rows:
        lang, source = (rest + [None, None])[:2]
        full.append((doc_id, text, lang, source, None if text is None else len(text), "k", 0.5, 1, 2, 3, "s"))
    return spark.createDataFrame(full, DOCS).repartition(3)


def sentence(seed, n, words=400):
    """n pseudo-words, the same for the same seed."""
    import random

    rng = random.Random(str(seed))
    return " ".join("".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(rng.randint(2, 4))) for _ in range(n))

"""Language identification with hyperdimensional profiles (Joshi, Halseth, Kanerva 2016).

Every letter has a random +1/-1 vector. An n-gram's vector binds the vectors
of its letters, each rotated by its place; a text bundles (adds) the vectors of
its n-grams; a language's prototype bundles all its texts. A text gets the
language whose prototype has the largest cosine with it.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

UNKNOWN = "und"
_BLANK = 32


@functools.lru_cache(maxsize=4)
class Space:
    """Vectors of letters and trigrams, made on demand from a seed and kept per worker."""

    def __init__(self, dim: int, seed: int, limit: int = 60_000):
        self.dim, self.seed, self.limit = dim, seed, limit
        self.letters: dict[int, np.ndarray] = {}
        self.place: dict[int, int] = {}
        self.vectors = np.empty((1024, dim), np.int8)

    def letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            bits = np.random.default_rng([self.seed, code]).integers(0, 2, self.dim, np.int8)
            self.letters[code] = 2 * bits - 1
        return self.letters[code]

    def of(self, grams: np.ndarray) -> np.ndarray:
        """Vectors of (unique) trigram codes, one a row."""
        if len(self.place) + len(grams) > self.limit:
            self.place.clear()
        out = np.empty(len(grams), np.int64)
        for i, g in enumerate(grams.tolist()):
            at = self.place.get(g)
            if at is None:
                at = self.place[g] = len(self.place)
                while at >= len(self.vectors):
                    self.vectors = np.concatenate([self.vectors, np.empty_like(self.vectors)])
                a, b, c = (self.letter(x) for x in (g >> 42, (g >> 21) & 0x1FFFFF, g & 0x1FFFFF))
                self.vectors[at] = np.roll(a, 2) * np.roll(b, 1) * c
            out[i] = at
        return self.vectors[out]




class _Letters(dict):
    """Translation of text: letters to lower case, everything else to a blank."""

    def __missing__(self, code: int) -> str:
        ch = chr(code)
        low = ch.lower() if ch.isalpha() else " "
        self[code] = low if len(low) == 1 else low[:1]
        return self[code]


_LETTERS = _Letters()


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Unique letter trigrams (words set off by one blank) and their counts."""
    words = text.translate(_LETTERS).split()
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    codes = np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le"), np.uint32).astype(np.int64)
    if len(codes) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.unique((codes[:-2] << 42) | (codes[1:-1] << 21) | codes[2:], return_counts=True)


def bundle(texts: list[str], space: Space) -> np.ndarray:
    """Vector of each text (rows of floats; zero if it has no letter)."""
    parts = [trigrams(t) for t in texts]
    used = np.unique(np.concatenate([p[0] for p in parts])) if parts else np.empty(0, np.int64)
    out = np.zeros((len(texts), space.dim), np.float32)
    for at in range(0, len(used), 8192):  # bounds the tables below
        block = used[at : at + 8192]
        counts = np.zeros((len(texts), len(block)), np.float32)
        for i, (grams, n) in enumerate(parts):
            lo, hi = np.searchsorted(grams, [block[0], block[-1] + 1])
            counts[i, np.searchsorted(block, grams[lo:hi])] = n[lo:hi]
        out += counts @ space.of(block).astype(np.float32)
    return out


def train(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", dim: int = 1024, seed: int = 11) -> dict[str, np.ndarray]:
    """Prototype of every language in ``docs`` (rows with null text or language take no part).

    Each task adds up the trigram counts of its rows by language, Spark sums
    them by (language, trigram), and the prototypes are again sums by language
    of count x vector, made where the counts are. The driver gets ``dim``
    numbers a language.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, dict[int, int]] = {}
        size = 0
        for b in batches:
            for lang, text in zip(b["lang"], b["text"]):
                own = sums.setdefault(lang, {})
                size -= len(own)
                for g, n in zip(*(x.tolist() for x in trigrams(text))):
                    own[g] = own.get(g, 0) + n
                size += len(own)
                if size > 500_000:  # bounds the task's memory
                    yield _counts(sums)
                    sums, size = {}, 0
        if sums:
            yield _counts(sums)

    def _counts(sums):
        return pd.DataFrame([(lang, g, n) for lang, own in sums.items() for g, n in own.items()], columns=["lang", "gram", "n"])

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        space = Space(dim, seed)
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, part in b.groupby("lang"):
                grams, n = part["gram"].to_numpy(np.int64), part["n"].to_numpy(np.float64)
                for at in range(0, len(grams), 4096):
                    vectors = space.of(grams[at : at + 4096]).astype(np.float64)
                    sums[lang] = sums.get(lang, 0) + n[at : at + 4096] @ vectors
        yield pd.DataFrame([(x, i, v) for x, s in sums.items() for i, v in enumerate(s.tolist())], columns=["lang", "i", "v"])

    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).dropna()
    counts = rows.mapInPandas(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    sums = counts.mapInPandas(weigh, "lang string, i int, v double").groupBy("lang", "i").agg(F.sum("v").alias("v"))
    out: dict[str, np.ndarray] = {}
    for r in sums.collect():  # languages x dim numbers, sums of whole numbers: exact in any order
        out.setdefault(r["lang"], np.zeros(dim))[r["i"]] = r["v"]
    return dict(sorted(out.items()))


def identify(
    spark: SparkSession,
    docs: DataFrame,
    prototypes: dict[str, np.ndarray],
    id_col: str = "doc_id",
    text_col: str = "text",
    dim: int = 1024,
    seed: int = 11,
) -> DataFrame:
    """doc_id, lang_pred, score for every row.

    Score: the cosine with the best prototype, not below 0 (equal cosines: the
    first language by name). Null texts and texts without a letter, and every
    text if nothing was learned, give ``und`` and 0. Whole texts count however
    long; null and repeated ids are kept; an empty table gives no rows.
    """
    names = list(prototypes)
    table = np.array([prototypes[n] / (np.linalg.norm(prototypes[n]) or 1.0) for n in names]).reshape(len(names), dim)
    shared = spark.sparkContext.broadcast((names, table.astype(np.float32)))

    @F.pandas_udf("struct<lang_pred:string,score:double>")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        space = Space(dim, seed)
        names, table = shared.value
        for texts in batches:
            pred = np.full(len(texts), UNKNOWN, object)
            score = np.zeros(len(texts))
            for at in range(0, len(texts) if names else 0, 128):
                x = bundle([t or "" for t in texts.iloc[at : at + 128]], space)
                length = np.linalg.norm(x, axis=1)
                some = np.flatnonzero(length)
                if len(some):
                    cos = (x[some] @ table.T) / length[some, None]
                    best = cos.argmax(axis=1)
                    pred[at + some] = np.array(names, object)[best]
                    score[at + some] = np.clip(cos[np.arange(len(best)), best], 0, 1)
            yield pd.DataFrame({"lang_pred": pred, "score": score})

    rows = docs.select(F.col(id_col).alias("doc_id"), predict(F.col(text_col)).alias("p"))
    return rows.select("doc_id", "p.lang_pred", "p.score")

"""Quality classifier: similarity-weighted vote of the nearest labelled texts.

Texts become TF-IDF vectors over hashed words and hashed word shapes; a
truncated SVD of the labelled sample makes them latent-semantic vectors. The
labelled vectors are broadcast, and every document's cosines with all of them
are computed in blocks; the most similar vote with their similarity as weight.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake.llm.common import free_memory, keeps_cache, only_caches_of

SHAPES, WORDS = 1024, 2048
ACCEPT = 0.7
#: Squeezed shapes are counted in pieces of this length; short, so that unspaced texts share pieces.
PIECE = 8
#: Longer tokens are not kept in the caches (an unspaced text is one token).
CACHED = 64


class _Shape(dict):
    """Translation of text to character classes."""

    def __missing__(self, code: int) -> str:
        ch = chr(code)
        if ch.isupper():
            self[code] = "A"
        elif ch.isalpha():
            self[code] = "a"
        elif ch.isdigit():
            self[code] = "0"
        else:
            self[code] = " " if ch.isspace() else ch
        return self[code]


_SHAPE = _Shape()
_SLOTS: dict[tuple[int, str], int] = {}


def _slot(kind: int, token: str, size: int) -> int:
    found = _SLOTS.get((kind, token))
    if found is None:
        found = zlib.crc32(f"{kind}:{token}".encode()) % size
        if len(token) <= CACHED:
            if len(_SLOTS) > 100_000:
                _SLOTS.clear()
            _SLOTS[kind, token] = found
    return found


_RUNS = re.compile(r"([Aa0])\1+")


def _squeeze(shape: str) -> list[str]:
    """'Aaaa' -> 'Aa', 'AAAA!!' -> 'A!!': runs of one class of letters or digits
    become one; of the whole token, in pieces of ``PIECE``."""
    short = _RUNS.sub(r"\1", shape)
    return [short[i : i + PIECE] for i in range(0, len(short), PIECE)]


_SQUEEZED: dict[str, list[str]] = {}


def _forget() -> None:
    _SLOTS.clear()
    _SQUEEZED.clear()


def raw_features(text: str) -> np.ndarray:
    """Counts of shapes and words of the whole text, dense; shape and word block apart."""
    x = np.zeros(SHAPES + WORDS, np.float32)
    lower = text.lower().split()
    if not lower:
        return x
    for shape, n in Counter(text.translate(_SHAPE).split()).items():
        pieces = _SQUEEZED.get(shape)
        if pieces is None:
            pieces = _squeeze(shape)
            if len(shape) <= CACHED:
                if len(_SQUEEZED) > 100_000:
                    _SQUEEZED.clear()
                _SQUEEZED[shape] = pieces
        for piece in pieces:
            x[_slot(0, piece, SHAPES)] += n
    for word, n in Counter(lower).items():
        x[SHAPES + _slot(1, word, WORDS)] += n
    # how repetitive the text is, window by window so that long texts compare with short ones
    shares = [len(set(lower[i : i + 100])) / len(lower[i : i + 100]) for i in range(0, len(lower), 100)]
    x[_slot(2, f"distinct {int(10 * sum(shares) / len(shares))}", SHAPES)] += 0.2 * len(lower)
    return x


def _weighted(raw: np.ndarray, idf: np.ndarray) -> np.ndarray:
    out = np.empty_like(raw)
    # of shapes the shares of the text tell most, of words that they occur
    for lo, hi, weight, damp in ((0, SHAPES, 1.0, np.sqrt), (SHAPES, SHAPES + WORDS, 0.35, np.log1p)):
        part = out[:, lo:hi]
        damp(raw[:, lo:hi], out=part)
        part *= idf[lo:hi]
        norm = np.linalg.norm(part, axis=1, keepdims=True)
        part *= weight / np.where(norm > 0, norm, 1)
    return out


def _right_singular(x: np.ndarray, dims: int) -> np.ndarray:
    """Leading right singular vectors by randomised subspace iteration (Halko et al. 2011)."""
    q = np.random.default_rng(0).standard_normal((x.shape[1], min(dims + 16, *x.shape))).astype(np.float32)
    for _ in range(5):
        q, _ = np.linalg.qr(x.T @ (x @ q))
    _, _, turn = np.linalg.svd(x @ q, full_matrices=False)
    return (q @ turn.T)[:, :dims].astype(np.float32)


class Model:
    """Labelled latent-semantic vectors and how to make such a vector of a text."""

    def __init__(self, raw: np.ndarray, labels: list[int], dims: int = 48, neighbours: int = 25):
        self.neighbours = neighbours
        self.labels = np.asarray(labels, np.float64)
        self.idf = (np.log((1 + len(raw)) / (1 + (raw > 0).sum(axis=0))) + 0.5).astype(np.float32)
        x = _weighted(raw, self.idf)
        self.basis = _right_singular(x, dims)
        self.vectors = self._unit(x @ self.basis)

    @staticmethod
    def _unit(v: np.ndarray) -> np.ndarray:
        norm = np.linalg.norm(v, axis=1, keepdims=True)
        return v / np.where(norm > 0, norm, 1)

    def score(self, texts: list[str], block: int = 1024) -> np.ndarray:
        """Share of label 1 among the nearest, weighted by similarity; 0.5 prior for none."""
        docs = self._unit(_weighted(np.stack([raw_features(t) for t in texts]), self.idf) @ self.basis)
        k = min(self.neighbours, len(self.labels))
        best_s = np.full((len(texts), 0), 0.0)
        best_l = np.full((len(texts), 0), 0.0)
        for at in range(0, len(self.labels), block):  # exact cosines, a block of labelled rows at a time
            s = docs @ self.vectors[at : at + block].T
            best_s = np.concatenate([best_s, s], axis=1)
            best_l = np.concatenate([best_l, np.broadcast_to(self.labels[at : at + block], s.shape)], axis=1)
            if best_s.shape[1] > k:
                top = np.argpartition(-best_s, k - 1, axis=1)[:, :k]
                best_s, best_l = np.take_along_axis(best_s, top, 1), np.take_along_axis(best_l, top, 1)
        weight = np.clip(best_s, 0, None) ** 8  # near ones count far more than merely related ones
        total = weight.sum(axis=1)
        vote = np.where(total > 0, (weight * best_l).sum(axis=1) / np.where(total > 0, total, 1), 0.5)
        return np.clip(vote, 0.0, 1.0)


def labelled_sample(docs: DataFrame, labels: DataFrame, may_learn: Column, per_class: int = 2000, seed: int = 5) -> DataFrame:
    """doc_id, text, label (0 or 1) of at most ``per_class`` documents of each label.

    ``may_learn`` is a condition on doc_id. The documents are those with the
    smallest hash of their id, so the choice depends neither on order nor on
    partitions. Ids without a document, null texts, null ids and other labels
    take no part; an id that is used by several documents counts with its first
    text. Only ids are compared with the labels: the texts are not shuffled,
    the picked ids are broadcast (at most 2 x ``per_class`` rows).
    """
    marks = labels.select("doc_id", F.col("quality").cast("int").alias("label")).where(may_learn & F.col("label").isin(0, 1))
    known = docs.where(F.col("text").isNotNull()).select("doc_id")
    marks = marks.dropDuplicates().join(known, "doc_id", "left_semi")
    order = (F.xxhash64("doc_id", F.lit(seed)), "doc_id")
    bad, good = (marks.where(F.col("label") == x).orderBy(*order).limit(per_class) for x in (0, 1))
    found = docs.select("doc_id", "text").dropna().join(F.broadcast(bad.union(good)), "doc_id")
    return found.groupBy("doc_id", "label").agg(F.min("text").alias("text"))


def fit(sample: DataFrame, **options) -> Model | None:
    """Fit on the rows of a bounded sample (doc_id, text, label); None if it is empty.

    The executors send the driver each row's nonzero features, a bounded size
    however long the text.
    """

    @F.pandas_udf("binary")
    def features(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            x = raw_features(t)
            at = np.flatnonzero(x)
            out.append(at.astype("<u2").tobytes() + x[at].tobytes())
        return pd.Series(out)

    rows = sample.select("doc_id", "label", features("text").alias("f")).orderBy("doc_id", "label").collect()
    if not rows:
        return None
    raw = np.zeros((len(rows), SHAPES + WORDS), np.float32)
    for i, r in enumerate(rows):
        n = len(r["f"]) // 6
        raw[i, np.frombuffer(r["f"], "<u2", n)] = np.frombuffer(r["f"], np.float32, n, 2 * n)
    return Model(raw, [r["label"] for r in rows], **options)


def scorer(spark: SparkSession, model: Model | None):
    """Column function text -> score in [0, 1] (null and empty texts are scored too; 0.5 without a model)."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        only_caches_of("quality")
        keeps_cache("quality", _forget)
        for texts in batches:
            out = np.full(len(texts), 0.5)
            for at in range(0, len(texts) if shared.value else 0, 128):
                out[at : at + 128] = shared.value.score([t or "" for t in texts.iloc[at : at + 128]])
            yield pd.Series(out)
        free_memory()

    return score

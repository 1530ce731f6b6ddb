"""Near-duplicates by Order MinHash (Marcais et al. 2019), checked by banded alignment.

A text is the sequence of its five-word shingles, each labelled with its
occurrence number. A sketch takes the few shingles of smallest hash under one
of many hash functions and keeps them in text order, so two texts share a
sketch often only if they have much in common in the same order. Pairs that
share one are aligned: matched shingles / (all shingles - matched) must reach
the threshold. Classes are the connected components of the links.
"""

from __future__ import annotations

import bisect
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelake.llm.common import Scratch, free_memory, materialize, only_caches_of, small

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)  # splitmix64 constants
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]  # of the base and of its inverse, as far as needed yet


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


@functools.lru_cache(maxsize=1)
def _in_word() -> np.ndarray:
    """Whether a code point is part of a word: letters, digits and underscore."""
    return np.array([chr(i).isalnum() or i == 95 for i in range(0x110000)])


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _POWERS[i] = np.multiply.accumulate(steps)
    return _POWERS[0][:n], _POWERS[1][:n]


def _word_hashes(text: str) -> np.ndarray:
    """Hash of each word of the lower-cased text, without a Python object a word.

    A word's hash is a polynomial in its mixed code points, taken from prefix
    sums over the text and shifted back by the inverse power of its start.
    """
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    inside = np.concatenate([[False], _in_word()[codes], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    up, down = _powers(len(codes))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mix(codes.astype(np.uint64) + np.uint64(1)) * up)])
    return _mix((sums[ends] - sums[starts]) * down[starts])


def shingles(text: str, words: int = 5) -> np.ndarray:
    """Occurrence-labelled shingle hashes of the whole text, in order.

    A text of fewer words, but not none, is one shingle; without words: none.
    """
    h = _word_hashes(text)
    if not len(h):
        return h
    k = min(words, len(h))
    x = np.zeros(len(h) - k + 1, np.uint64)
    for i in range(k):
        x = _mix(x * np.uint64(0x9E3779B97F4A7C15) + h[i : i + len(x)])
    order = np.argsort(x, kind="stable")
    same = x[order]
    first = np.flatnonzero(np.concatenate([[True], same[1:] != same[:-1]]))
    if len(first) < len(x):
        occurrence = np.arange(len(x)) - np.repeat(first, np.diff(np.append(first, len(x))))
        label = np.empty(len(x), np.uint64)
        label[order] = occurrence
        x = _mix(x + label)
    return x


def _unrepeated(x: np.ndarray) -> np.ndarray:
    """``x`` without later repeats: of shingles that are equal once cut to 32 bits the first stays."""
    _, first = np.unique(x, return_index=True)
    return x if len(first) == len(x) else x[np.sort(first)]


def sketches(x: np.ndarray, size: int, count: int, salt: int) -> np.ndarray:
    """``count`` keys: the ``size`` smallest shingles under each hash, hashed in text order."""
    if not len(x):
        return np.empty(0, np.int64)
    size = min(size, len(x))
    seeds = _mix(np.arange(salt, salt + count, dtype=np.uint64))
    picked = np.empty((count, size), np.int64)
    step = max(1, 1_000_000 // len(x))  # bounds the matrix for very long texts
    for i in range(0, count, step):
        order = x[None, :] * (seeds[i : i + step, None] | np.uint64(1))
        picked[i : i + step] = np.argpartition(order, size - 1, axis=1)[:, :size] if size < len(x) else np.arange(size)
    picked.sort(axis=1)
    keys = seeds.copy()
    for column in x[picked].T:
        keys = _mix(keys * np.uint64(0x9E3779B97F4A7C15) + column)
    return keys.view(np.int64)


SIGNATURE_BITS = 256
#: Differences to a leader are kept up to this many shingles and half of the text's.
MOST_APART = 128


def signature(x: np.ndarray) -> np.ndarray:
    """One bit of each of 256 minima (b-bit minwise hashing, Li and Koenig 2010), as four longs.

    Two texts differ in a bit with probability (1 - Jaccard) / 2.
    """
    if not len(x):
        return np.zeros(SIGNATURE_BITS // 64, np.int64)
    seeds = _mix(np.arange(5001, 5001 + SIGNATURE_BITS, dtype=np.uint64)) | np.uint64(1)
    low = np.empty(SIGNATURE_BITS, np.uint64)
    step = max(1, 1_000_000 // len(x))
    for i in range(0, SIGNATURE_BITS, step):
        low[i : i + step] = (x[None, :] * seeds[i : i + step, None]).min(axis=1)
    bits = (_mix(low) & np.uint64(1)).astype(np.uint8)
    return np.packbits(bits).view("<i8")


def differing_bits(a: str, b: str) -> Column:
    """Bits in which two signature columns (structs s0 to s3) differ."""
    total = F.lit(0)
    for i in range(SIGNATURE_BITS // 64):
        total = total + F.bit_count(F.col(f"{a}.s{i}").bitwiseXOR(F.col(f"{b}.s{i}")))
    return total


def most_differing_bits(threshold: float, sigmas: float = 6.0) -> int:
    """A pair at the threshold differs in more bits than this with the chance of so many sigmas."""
    p = (1 - threshold) / 2
    return int(SIGNATURE_BITS * p + sigmas * (SIGNATURE_BITS * p * (1 - p)) ** 0.5)


def aligned(a: np.ndarray, b: np.ndarray, threshold: float) -> float:
    """Matched shingles / (all - matched) of the best alignment inside the band.

    Labelled shingles are unique in a text, so an alignment is an increasing
    run of matched places. Texts this similar differ by at most
    (len a + len b)(1 - t)/(1 + t) insertions and deletions, so matches farther
    off the diagonal can't be part of a sufficient alignment and are left out.
    """
    if not len(a) or not len(b):
        return 0.0
    both, ia, ib = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    total = len(a) + len(b)
    if len(both) < threshold * (total - len(both)):
        return 0.0  # even all shared shingles would not do
    band = total * (1 - threshold) / (1 + threshold)
    near = np.abs(ia - ib) <= band
    places = ib[near][np.argsort(ia[near])]
    if len(places) > 1 and not (np.diff(places) > 0).all():
        tails: list[int] = []
        for p in places.tolist():
            at = bisect.bisect_left(tails, p)
            if at == len(tails):
                tails.append(p)
            else:
                tails[at] = p
        matched = len(tails)
    else:
        matched = len(places)
    return matched / (total - matched)


def components(links: DataFrame, write: Callable[[DataFrame, str], DataFrame] = materialize) -> DataFrame:
    """node, comp (smallest node) of the connected components of links (a, b).

    Alternates large-star and small-star steps (Kiveris et al. 2014); each
    round is written and read again, which cuts the lineage.
    """
    edges = write(links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small_star = joined.select("u", F.col("m").alias("v")).union(joined.select(F.col("v").alias("u"), F.col("m").alias("v")))
        new = write(small_star.where("u <> v").distinct(), "star")
        digest = [F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))]
        if edges.agg(*digest).collect() == new.agg(*digest).collect():
            return new.select(F.col("u").alias("node"), F.col("v").alias("comp"))
        edges = new


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.8,
    words: int = 5,
    size: int = 6,
    count: int = 48,
    short: int = 32,
) -> DataFrame:
    """doc_id, class_id, n_class, n_shingles for every row.

    ``class_id``: smallest id in the row's class; ``n_class``: rows in it. Rows
    with equal texts are one node of the graph. Every pair of different texts
    that shares a sketch is either aligned or already in one class: first every
    text against two leaders (of its buckets' most often met members the most
    often met and the most alike), then, in buckets that still hold several
    classes, all members against the hub of the largest class, and the members
    outside that class against all of another class. Left out while joining, so that they make no rows, are pairs that
    cannot reach the threshold: by their lengths, by their 256-bit signatures
    (six sigmas), or because they share too few shingles, which is known exactly
    once both were compared with the hub: a pair shares what the hub has and
    neither lacks, and what both add to it. So no link found is lost and a group of
    copies costs a star, not all of its pairs. Sketches of ``size`` shingles
    meet with a probability of about threshold ** size each, ``count`` times.
    Texts of at most 1.25 x ``short`` shingles also have 16 sketches of two, as
    for them six is too strict.

    Null texts and texts without a word are classes of their own, but equal
    texts always share one. Null ids come last in the choice of class_id (a
    class of null ids only has null). Repeated ids are rows like any other. An
    empty table gives no rows; other columns are not read.
    """
    tables = Scratch(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("node", F.unhex(F.md5("text")))

    @F.pandas_udf("struct<n:int,keys:array<bigint>,seq:binary,s0:bigint,s1:bigint,s2:bigint,s3:bigint>")
    def sketch(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        only_caches_of("near-dup")
        for texts in batches:
            for at in range(0, len(texts), 500):  # short batches out: bounded memory
                out = []
                for text in texts.iloc[at : at + 500]:
                    x = shingles(text or "", words)
                    seq = _unrepeated(x.astype("<u4"))
                    keys = [sketches(x, size, count, 1)] if len(x) >= short else []
                    if len(x) <= 1.25 * short:
                        keys.append(sketches(x, 2, 16, 1001))
                    out.append((len(seq), np.concatenate(keys), seq.tobytes(), *signature(x).tolist()))
                yield pd.DataFrame(out, columns=["n", "keys", "seq", "s0", "s1", "s2", "s3"])
        free_memory()

    base = rows.select("doc_id", "node", sketch("text").alias("s"))
    bits = F.struct(*[F.col(f"s.s{i}") for i in range(4)]).alias("bits")
    base = tables.write(base.select("doc_id", "node", "s.n", "s.keys", "s.seq", bits), "sketches")

    # one row a text, then the buckets of two texts or more
    texts = base.where(F.col("node").isNotNull() & (F.col("n") > 0))
    nodes = tables.write(texts.groupBy("node").agg(*[F.first(c).alias(c) for c in ("n", "keys", "bits")]), "texts")
    members = nodes.select(F.explode("keys").alias("key"), "node", "n")
    buckets = members.groupBy("key").agg(F.count(F.lit(1)).alias("g")).where("g > 1")
    members = tables.write(members.join(buckets, "key"), "repeated-keys")
    met = members.groupBy("node").agg(F.sum("g").alias("met"))
    members = tables.write(members.join(met, "node").select("key", "node", "n", "met"), "buckets")

    # each text against two leaders of its buckets: the one most often met, and the most alike
    lead = members.groupBy("key").agg(F.max(F.struct("met", "node", "n")).alias("top"))
    lead = lead.select("key", F.col("top.node").alias("lead"), F.col("top.n").alias("na"), F.col("top.met").alias("lead_met"))
    fits = F.least("n", "na") >= F.lit(threshold) * F.greatest("n", "na")
    offered = members.join(lead, "key").where((F.col("node") != F.col("lead")) & fits).select("node", "lead", "lead_met").distinct()
    bits_of = lambda c, name: nodes.select(F.col("node").alias(c), F.col("bits").alias(name))
    offered = offered.join(bits_of("lead", "x"), "lead").join(bits_of("node", "y"), "node").withColumn("off", differing_bits("x", "y"))
    offered = offered.where(F.col("off") <= most_differing_bits(threshold))
    best = offered.groupBy("node").agg(
        F.max(F.struct("lead_met", "lead")).alias("m"), F.max(F.struct(-F.col("off"), "lead_met", "lead")).alias("l")
    )
    best = tables.write(best.select("node", F.col("m.lead").alias("lead"), F.col("l.lead").alias("like")), "chosen")
    star = best.select(F.col("lead").alias("a"), F.col("node").alias("b")).union(best.select("like", "node")).distinct()
    compared = tables.write(_compared(star, texts, threshold, tables), "star-compared")
    links = compared.where(F.col("similarity") >= threshold).select("a", "b")

    # what the star may have missed: pairs across classes inside a bucket
    comp = components(links, tables.write)
    marked = members.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    sizes = marked.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("c"))
    several = sizes.groupBy("key").agg(F.count(F.lit(1)).alias("comps"), F.max(F.struct("c", "comp")).alias("top")).where("comps > 1")
    hubs = marked.groupBy("comp").agg(F.max(F.struct("met", "node"))["node"].alias("hub")).withColumnRenamed("comp", "top")
    several = several.select("key", F.col("top.comp").alias("top")).join(hubs, "top")
    mixed = tables.write(marked.drop("met").join(several, "key"), "mixed-buckets")
    # each member of such a bucket against one text, the hub of the bucket's largest class
    spokes = mixed.where(F.col("node") != F.col("hub")).select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    spokes = tables.write(spokes.join(compared.select("a", "b"), ["a", "b"], "left_anti"), "spokes")
    spokes = tables.write(_compared(spokes, texts, threshold, tables), "spokes-compared")
    found = spokes.where(F.col("similarity") >= threshold).select("a", "b")
    apart = compared.union(spokes).select(F.col("a").alias("hub"), F.col("b").alias("node"), "shared", "added", "missing")
    mixed = mixed.join(nodes.select("node", "bits"), "node").join(apart, ["hub", "node"], "left")
    itself = F.col("node") == F.col("hub")
    mixed = mixed.withColumn("shared", F.when(itself, F.col("n")).otherwise(F.col("shared")))
    mixed = mixed.withColumns({c: F.when(itself, F.array().cast("array<int>")).otherwise(F.col(c)) for c in ("added", "missing")})
    mixed = tables.write(mixed, "mixed-members")
    names = (("node", "a"), ("comp", "ca"), ("n", "na"), ("bits", "x"), ("shared", "sx"), ("added", "ax"), ("missing", "mx"))
    left = mixed.where(F.col("comp") != F.col("top")).select("key", "hub", *[F.col(c).alias(d) for c, d in names])
    names = (("node", "b"), ("comp", "cb"), ("n", "n"), ("bits", "y"), ("added", "ay"), ("missing", "my"))
    right = mixed.select("key", *[F.col(c).alias(d) for c, d in names], (F.col("comp") == F.col("top")).alias("big"))
    once = (F.col("ca") != F.col("cb")) & (F.col("big") | (F.col("a") < F.col("b")))
    alike = fits & (differing_bits("x", "y") <= most_differing_bits(threshold))
    done = (F.col("a") == F.col("hub")) | (F.col("b") == F.col("hub"))
    # two texts share what the hub has and neither lacks, and what both add to it
    most = F.col("sx") + F.size("mx") - F.size(F.array_union("mx", "my")) + F.size(F.array_intersect("ax", "ay"))
    enough = most >= F.lit(threshold / (1 + threshold)) * (F.col("na") + F.col("n")) - 1e-6
    known = F.col("ax").isNotNull() & F.col("ay").isNotNull()  # with them mx and my
    cross = left.join(right, (left["key"] == right["key"]) & once & alike & ~done & F.when(known, enough).otherwise(F.lit(True)))
    cross = cross.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    cross = tables.write(cross, "cross-pairs")
    more = _compared(cross, texts, threshold, tables).where(F.col("similarity") >= threshold)
    more = tables.write(found.union(more.select("a", "b")), "cross-links")
    if not more.isEmpty():
        comp = components(links.union(more), tables.write)

    lone = F.unhex(F.md5(F.concat(F.lit("null text "), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))))
    placed = base.select("doc_id", "node", "n").join(comp, "node", "left")
    placed = placed.select("doc_id", F.coalesce("comp", "node", lone).alias("comp"), F.col("n").alias("n_shingles"))
    placed = tables.write(placed, "placed")
    tables.clear("placed")
    classes = placed.groupBy("comp").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("n_class"))
    return placed.join(classes, "comp").select("doc_id", "class_id", "n_class", "n_shingles")


def _compared(pairs: DataFrame, texts: DataFrame, threshold: float, tables: Scratch) -> DataFrame:
    """a, b, similarity (aligned), shared (shingles in both), added (those of b that a lacks), missing (those of a that b lacks).

    The last two are null where they are too many (``MOST_APART``).
    """
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    nodes = small(tables.write(nodes, "pair-nodes"))  # so the sequences of other texts stay where they are
    wanted = texts.select("node", "seq").join(nodes, "node", "left_semi").groupBy("node").agg(F.first("seq").alias("seq"))
    wanted = tables.write(wanted, "pair-texts")

    @F.pandas_udf("struct<similarity:double,shared:int,added:array<int>,missing:array<int>>")
    def compare(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        out = []
        for x, y in zip(a, b):
            x, y = np.frombuffer(x, "<u4"), np.frombuffer(y, "<u4")
            added, missing = np.setdiff1d(y, x, assume_unique=True), np.setdiff1d(x, y, assume_unique=True)
            few = max(len(added), len(missing)) <= MOST_APART + len(y) // 2
            apart = (added.view(np.int32), missing.view(np.int32)) if few else (None, None)
            out.append((aligned(x, y, threshold), len(y) - len(added), *apart))
        free_memory()
        return pd.DataFrame(out, columns=["similarity", "shared", "added", "missing"])

    both = pairs.join(wanted.select(F.col("node").alias("a"), F.col("seq").alias("sa")), "a")
    both = both.join(wanted.select(F.col("node").alias("b"), F.col("seq").alias("sb")), "b")
    return both.select("a", "b", compare("sa", "sb").alias("c")).select("a", "b", "c.*")

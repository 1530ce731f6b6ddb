"""Phrase collocations counted with weighted acyclic automata.

Every word starts one sequence of at most four words that ends with its piece.
A task sorts its sequences and builds an automaton from them: a state is a
prefix, an arc is a word, a final arc carries the number of occurrences, so the
weight of a prefix is the sum of what is below it and one automaton holds the
counts of all n-grams of one to four words. The automata are cut at bounds of
the sorted sequences; one task per prefix range unites what all others sent,
adds the weights, and reads off the counts. The parts of a candidate are looked
up in the summed counts.

The automaton is kept in tree form: with counts on the final arcs hardly two
states accept the same endings with the same weights, so merging states would
save little.
"""

from __future__ import annotations

import bisect
import itertools
import pickle
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelake.llm.common import Scratch, free_memory, small

MOST_WORDS = 4
#: Sequences in one automaton, and about as many (before they are united) in one prefix range.
BLOCK_ROWS, RANGE_ROWS = 32_000, 300_000
#: Words after which a task sends its automata on.
SHARD_WORDS = 1_000_000
#: Most shards that are united at once; more are united in several rounds.
FAN_IN = 256

_ENDS = re.compile(rb"[.,;:!?\x0A-\x0D\x20\x09]")
_TO_STOPS = bytes.maketrans(b",;:!?\n\x0b\x0c\r", b"." * 9)


def _runs(rows: np.ndarray) -> np.ndarray:
    """Places at which a sorted table of sequences changes, for each prefix length (columns)."""
    new = np.ones(rows.shape, bool)
    if len(rows):
        new[1:] = np.logical_or.accumulate(rows[1:] != rows[:-1], axis=1)
    return new


def _sorted_order(rows: np.ndarray, words: int) -> np.ndarray:
    """Order of sequences of ranks up to ``words``: one sort of 64-bit keys, then of the few that only differ below."""
    bits = int(words).bit_length()
    wide = lambda k: rows[:, k].astype(np.uint64)
    if bits > 21:
        return np.lexsort((wide(2) << np.uint64(32) | wide(3), wide(0) << np.uint64(32) | wide(1)))
    below = max(0, 4 * bits - 64)  # bits of the last word that the key has no place for
    key = wide(0)
    for k, shift in ((1, bits), (2, bits), (3, bits - below)):
        key <<= np.uint64(shift)
        key |= wide(k) >> np.uint64(bits - shift)
    order = np.argsort(key)
    if below:
        key = key[order]
        same = np.concatenate([[False], key[1:] == key[:-1], [False]])
        tied = np.flatnonzero(same[1:] | same[:-1])
        if len(tied):
            some = order[tied]
            order[tied] = some[np.lexsort((rows[some, 3], key[tied]))]
    return order


def _narrow(x: np.ndarray) -> np.ndarray:
    return x.astype(np.min_scalar_type(int(x.max()) if len(x) else 0))


class Automaton:
    """Weighted acyclic automaton of word sequences.

    words: the words in use, in order of their bytes with the end mark;
    rows: the accepted sequences, sorted and different, as ranks from 1 (0: no
    word); weights: how often each occurs.
    """

    def __init__(self, words: list[bytes], rows: np.ndarray, weights: np.ndarray):
        self.words, self.rows, self.weights = words, rows, weights

    @classmethod
    def of(cls, words: list[bytes], rows: np.ndarray, weights: np.ndarray | None = None) -> Automaton:
        """From sequences in any order: sorted, equal ones added up. No weights: each counts once."""
        order = _sorted_order(rows, len(words)).astype(np.int32)
        rows = rows[order]
        at = np.flatnonzero(_runs(rows)[:, -1])
        if weights is None:
            weights = np.diff(np.append(at, len(rows)))
        elif len(at):
            weights = np.add.reduceat(weights[order], at)
        return cls(words, rows[at], weights)

    def part(self, first: int, last: int) -> Automaton:
        """The sequences [first, last), with the words that they use."""
        rows = self.rows[first:last]
        used = np.zeros(len(self.words) + 1, bool)
        used[rows.ravel()] = True
        used[0] = False
        coded = np.cumsum(used, dtype=np.int32)
        coded[0] = 0
        return Automaton(list(map(self.words.__getitem__, (np.flatnonzero(used) - 1).tolist())), coded[rows], self.weights[first:last])

    def key(self, i: int) -> bytes:
        """Sequence ``i`` as bytes that sort as the sequences do: each word closed by a tab, which no word has."""
        return b"".join(self.words[w - 1] + b"\t" for w in self.rows[i].tolist() if w)

    def dump(self) -> bytes:
        """Arcs by depth: their words and how many arcs follow each; then the weights of the final arcs."""
        new, rows = _runs(self.rows), self.rows
        labels, fans = [], []
        for k in range(MOST_WORDS):
            arcs = np.flatnonzero(new[:, k] & (rows[:, k - 1] > 0)) if k else np.flatnonzero(new[:, 0])
            labels.append(_narrow(rows[arcs, k]))
            if k:
                # arcs that follow each arc of the depth before
                above = np.flatnonzero(new[:, k - 1] & (rows[:, k - 1] > 0))
                fans.append(_narrow(np.diff(np.append(np.searchsorted(arcs, above), len(arcs)))))
        packed = pickle.dumps((b"\n".join(self.words), labels, fans, _narrow(self.weights)), protocol=5)
        return zstandard.ZstdCompressor(level=1).compress(packed)

    @classmethod
    def load(cls, data: bytes) -> Automaton:
        words, labels, fans, weights = pickle.loads(zstandard.ZstdDecompressor().decompress(data))
        # sequences through each arc, from the last words up
        through = [np.ones(len(x), np.int64) for x in labels]
        for k in range(MOST_WORDS - 2, -1, -1):
            fan = fans[k].astype(np.int64)
            if len(fan):
                through[k][labels[k] > 0] = np.add.reduceat(through[k + 1], np.cumsum(fan) - fan)
        rows = np.zeros((len(weights), MOST_WORDS), np.int32)
        rows[:, 0] = np.repeat(labels[0], through[0])
        for k in range(1, MOST_WORDS):
            rows[rows[:, k - 1] > 0, k] = np.repeat(labels[k], through[k])
        return cls(words.split(b"\n"), rows, weights.astype(np.int64))

    @classmethod
    def union(cls, automata: Iterable[Automaton]) -> Automaton:
        """Accepts what any of them accepts, weights added; they are taken one after the other."""
        codes: dict[bytes, int] = defaultdict(itertools.count(1).__next__)
        parts, weights = [], []
        for a in automata:
            own = np.fromiter(map(codes.__getitem__, a.words), np.int32, len(a.words))
            parts.append(np.concatenate([np.zeros(1, np.int32), own])[a.rows])
            weights.append(a.weights)
        rows = np.concatenate(parts)
        parts.clear()
        words = list(codes)
        order = sorted(range(len(words)), key=[w + b"\t" for w in words].__getitem__)
        rank = np.zeros(len(words) + 1, np.int32)
        rank[np.array(order, np.int64) + 1] = np.arange(1, len(words) + 1)
        for k in range(MOST_WORDS):
            rows[:, k] = rank[rows[:, k]]
        return cls.of([words[i] for i in order], rows, np.concatenate(weights))

    def blocks(self, rows: int) -> Iterator[tuple[bytes, bytes, int, bytes]]:
        """(first key, last key, sequences, automaton) of runs of ``rows`` sequences."""
        for at in range(0, len(self.rows), rows):
            a = self.part(at, at + rows)
            yield a.key(0), a.key(len(a.rows) - 1), len(a.rows), a.dump()

    def prefixes(self, least: int) -> Iterator[tuple[str, int, int]]:
        """(phrase, words, weight) of every prefix of at least that weight, and of those on the rim.

        A prefix of the first or the last sequence may go on in the next range,
        so its weight here may be a part of its count.
        """
        new = _runs(self.rows)
        for k in range(MOST_WORDS):
            at = np.flatnonzero(new[:, k])
            if not len(at):
                return
            sums = np.add.reduceat(self.weights, at)
            keep = sums >= least
            keep[[0, -1]] = True
            keep &= self.rows[at, k] > 0
            for i, f in zip(at[keep].tolist(), sums[keep].tolist()):
                yield b" ".join(self.words[w - 1] for w in self.rows[i, : k + 1].tolist()).decode("utf-8", "replace"), k + 1, f


def _codes() -> dict[bytes, int]:
    """Numbers words in order of their first use, from 1; 0 is the end of a piece."""
    codes: dict[bytes, int] = defaultdict(itertools.count().__next__)
    codes[b"."]
    return codes


class Shard:
    """Gathers the words of a task by language and turns them into automata."""

    def __init__(self, limit: int = SHARD_WORDS):
        self.limit = limit
        self.ids: dict[str, list[int]] = {}
        self.codes: dict[str, dict[bytes, int]] = {}
        self.held = 0

    def add(self, lang: str, text: bytes, run: int = 1 << 20) -> Iterator[tuple[str, Automaton]]:
        """Adds a text in runs of about ``run`` bytes; gives automata when the limit is reached."""
        at = 0
        while at < len(text):
            cut = _ENDS.search(text, at + run) if at + run < len(text) else None
            end = cut.start() if cut else len(text)
            if lang not in self.ids:
                self.ids[lang], self.codes[lang] = [], _codes()
            ids, codes = self.ids[lang], self.codes[lang]
            before = len(ids)
            # a stop is a word by itself, numbered 0; no word holds one
            stops = text[at:end].lower().translate(_TO_STOPS).replace(b".", b" . ")
            ids.extend(map(codes.__getitem__, stops.split()))
            at = end
            if at == len(text):
                ids.append(0)
            self.held += len(ids) - before
            if self.held >= self.limit:
                yield from self.flush()

    def flush(self) -> Iterator[tuple[str, Automaton]]:
        """All that is held; the last words of an unfinished piece stay, as their sequences aren't known yet."""
        for lang in sorted(self.ids):
            ids, names = np.array(self.ids[lang], np.int64), list(self.codes[lang])[1:]
            tail = ids[-(MOST_WORDS - 1) :]
            open_words = len(tail) - (np.flatnonzero(tail == 0)[-1] + 1 if (tail == 0).any() else 0)
            order = sorted(range(len(names)), key=[w + b"\t" for w in names].__getitem__)
            rank = np.zeros(len(names) + 1, np.int32)
            rank[np.array(order, np.int64) + 1] = np.arange(1, len(names) + 1)
            v = np.concatenate([rank[ids], np.zeros(MOST_WORDS - 1, np.int32)])
            rows = np.empty((len(ids), MOST_WORDS), np.int32)
            rows[:, 0] = v[: len(ids)]
            for k in range(1, MOST_WORDS):
                rows[:, k] = np.where(rows[:, k - 1] > 0, v[k : len(ids) + k], 0)
            rows = rows[: len(ids) - open_words]
            rows = rows[rows[:, 0] > 0]
            kept = [names[i - 1] for i in ids[len(ids) - open_words :].tolist()]
            self.codes[lang] = _codes()
            self.ids[lang] = [self.codes[lang][w] for w in kept]
            if len(rows):
                yield lang, Automaton.of([names[i] for i in order], rows)
        self.ids = {lang: ids for lang, ids in self.ids.items() if ids}
        self.held = sum(map(len, self.ids.values()))


def shard_automata(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", shard_words: int = SHARD_WORDS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """lang, shard, first, last (bounds of the sequences), n (sequences), automaton."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number = Shard(shard_words), TaskContext.get().partitionId() << 32

        def rows(found: Iterator[tuple[str, Automaton]]) -> Iterator[pa.RecordBatch]:
            for lang, whole in found:
                for block in whole.blocks(block_rows):
                    yield _record(_BLOCK, [(lang, number, *block)])
            free_memory()

        for batch in batches:
            for lang, text in zip(batch.column("lang"), batch.column("text")):  # a text at a time
                held = shard.held
                yield from rows(shard.add(lang.as_py(), text.as_py() or b""))
                number += shard.held < held  # it was flushed: the next words are another shard
        yield from rows(shard.flush())

    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    docs = docs.select(lang.alias("lang"), F.col(text_col).cast("binary").alias("text"))
    return docs.mapInArrow(run, _SCHEMA)


_SCHEMA = "lang string, shard long, first binary, last binary, n long, automaton binary"
_COLUMNS = [c.split()[0] for c in _SCHEMA.split(", ")]
_BLOCK = pa.schema(list(zip(_COLUMNS, (pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.binary()))))
_PIECE = pa.schema([("lang", pa.string()), ("shard", pa.int64()), ("range", pa.int32()), ("automaton", pa.binary())])


def _record(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def range_bounds(blocks: DataFrame, ranges: int) -> list[tuple[str, bytes]]:
    """Ascending starts (lang, first) of about ``ranges`` prefix ranges of equally many sequences."""
    dealt = blocks.select("lang", "first").repartitionByRange(ranges, "lang", "first")
    least = dealt.groupBy(F.spark_partition_id().alias("range")).agg(F.min(F.struct("lang", "first")).alias("b"))
    return sorted((r.b.lang, bytes(r.b.first)) for r in least.collect())


def cut_at(blocks: DataFrame, bounds: list[tuple[str, bytes]]) -> DataFrame:
    """lang, shard, range, automaton: each block in the ranges that it reaches into."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, shard, first, last, data in zip(*(batch.column(c) for c in ("lang", "shard", "first", "last", "automaton"))):
                lang, shard, data = lang.as_py(), shard.as_py(), data.as_py()  # a block at a time
                lo = max(0, bisect.bisect_right(bounds, (lang, first.as_py())) - 1)
                hi = max(0, bisect.bisect_right(bounds, (lang, last.as_py())) - 1)
                if lo == hi:
                    yield _record(_PIECE, [(lang, shard, lo, data)])
                    continue
                whole, at, out = Automaton.load(data), 0, []
                for r in range(lo, hi + 1):
                    n = len(whole.rows)
                    end = bisect.bisect_left(range(n), bounds[r + 1][1], lo=at, key=whole.key) if r < hi else n
                    if end > at:
                        out.append((lang, shard, r, whole.part(at, end).dump()))
                    at = end
                yield _record(_PIECE, out)
        free_memory()

    return blocks.mapInArrow(cut, "lang string, shard long, range int, automaton binary")


def united_shards(blocks: DataFrame, shards: int, range_rows: int, block_rows: int, fan_in: int, tables: Scratch) -> DataFrame:
    """The same blocks with at most ``fan_in`` shards, united in rounds.

    The last union cuts every shard at the bounds of all ranges; without these
    rounds shards and ranges would both grow with the corpus, and the pieces
    with its square.
    """

    def unite(group: pd.DataFrame) -> pd.DataFrame:
        whole = Automaton.union(map(Automaton.load, group["automaton"]))
        same = (group["lang"].iloc[0], int(group["shard"].iloc[0]))
        return pd.DataFrame([(*same, *b) for b in whole.blocks(block_rows)], columns=_COLUMNS)

    while shards > fan_in:
        shards = -(-shards // fan_in)
        total = blocks.agg(F.sum("n")).first()[0]
        bounds = range_bounds(blocks, max(1, -(-total // (shards * range_rows))))
        grouped = blocks.withColumn("shard", F.pmod(F.xxhash64("shard"), F.lit(shards)))
        sent = cut_at(grouped, bounds).groupBy("shard", "range", "lang")
        blocks = tables.write(sent.applyInPandas(unite, _SCHEMA), "united-automata")
    return blocks


def summed_counts(blocks: DataFrame, bounds: list[tuple[str, bytes]], least: int, tables: Scratch) -> DataFrame:
    """lang, phrase, k (words), f of all phrases that occur at least ``least`` times; phrase null, k 0: all words."""

    def unite(group: pd.DataFrame) -> pd.DataFrame:
        lang = group["lang"].iloc[0]
        whole = Automaton.union(map(Automaton.load, group["automaton"]))
        rows = [(lang, *p) for p in whole.prefixes(least)]
        rows.append((lang, None, 0, int(whole.weights.sum())))
        del whole
        free_memory()
        return pd.DataFrame(rows, columns=["lang", "phrase", "k", "f"])

    # a range has one language, but for the rims of two
    found = cut_at(blocks, bounds).groupBy("range", "lang").applyInPandas(unite, "lang string, phrase string, k int, f long")
    summed = found.groupBy("lang", "phrase", "k").agg(F.sum("f").alias("f"))
    return tables.write(summed.where((F.col("f") >= least) | F.col("phrase").isNull()), "phrase-counts")


def score(a: str, l: str, r: str) -> Column:  # noqa: E741
    """floor(2000000 a / (l + r)), exact also where the product passes 64 bits."""
    return F.expr(f"(2000000 * CAST({a} AS decimal(19,0))) div (CAST({l} AS decimal(19,0)) + CAST({r} AS decimal(19,0)))")


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = 30,
    top: int = 2000,
    shard_words: int = SHARD_WORDS,
    block_rows: int = BLOCK_ROWS,
    range_rows: int = RANGE_ROWS,
    fan_in: int = FAN_IN,
    buckets: int = 32,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``top`` phrases.

    A phrase is two to four neighbouring words of a piece; a, l and r count it,
    its first part and the rest at its lowest-scoring cut, score is
    floor(2000000 a / (l + r)), n counts the language's words. A phrase inside a
    longer candidate that has at least 80 % of its occurrences is left out.

    Null language: 'und'; null, empty and wordless texts have no words, so a
    language of such texts has no rows. Repeated rows count as often as they
    occur. A word of any length is one word; very long texts are read in runs.
    An empty table gives no rows; other columns are not read.
    """
    tables = Scratch(docs.sparkSession)
    blocks = tables.write(shard_automata(docs, text_col, lang_col, shard_words, block_rows), "shard-automata")
    shards, total = blocks.agg(F.count_distinct("shard"), F.sum("n")).first()
    blocks = united_shards(blocks, shards, range_rows, block_rows, fan_in, tables)
    counts = summed_counts(blocks, range_bounds(blocks, max(1, -(-(total or 0) // range_rows))), least, tables)
    words = counts.where(F.col("phrase").isNull()).select("lang", F.col("f").alias("n"))
    grams = counts.where(F.col("phrase").isNotNull())

    candidates = grams.where("k > 1").select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    at = F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("cut")
    cuts = candidates.select("lang", "phrase", "a", "w", at)
    cuts = cuts.withColumn("first", F.array_join(F.slice("w", F.lit(1), F.col("cut")), " "))
    cuts = cuts.withColumn("rest", F.array_join(F.slice("w", F.col("cut") + 1, F.size("w")), " ")).drop("w")
    cuts = cuts.join(grams.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(grams.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    scored = cuts.withColumn("score", score("a", "l", "r")).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("s"))

    # every phrase inside a longer candidate, with the largest count of such a candidate
    inner = F.expr(
        "flatten(transform(sequence(2, size(w) - 1), m -> transform(sequence(1, size(w) - m + 1), i -> array_join(slice(w, i, m), ' '))))"
    )
    inside = candidates.where(F.size("w") > 2).select("lang", F.explode(inner).alias("phrase"), "a")
    inside = inside.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = scored.join(inside, ["lang", "phrase"], "left")
    kept = kept.where(F.expr("longer IS NULL OR 100 * CAST(longer AS decimal(19,0)) < 80 * CAST(a AS decimal(19,0))"))
    kept = kept.select("lang", "phrase", "a", "s.l", "s.r", "s.score")

    # a language's best of each bucket first, so no task gets all phrases of one language
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    bucket = Window.partitionBy("lang", "bucket").orderBy(*order)
    kept = kept.withColumn("bucket", F.pmod(F.xxhash64("phrase"), F.lit(buckets)))
    kept = kept.withColumn("rank", F.row_number().over(bucket)).where(F.col("rank") <= top).drop("rank")
    kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    out = kept.join(small(words), "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    tables.clear("phrase-counts")
    return out

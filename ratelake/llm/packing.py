"""Packing token sequences by Karmarkar-Karp multiway differencing."""

from __future__ import annotations

import functools
import heapq
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelake.llm.common import free_memory, keeps_cache, only_caches_of

PIECE_SCHEMA = (
    "doc_id string, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, sequence_tokens long"
)


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """Split items into ``k`` windows of near-equal sums (largest differencing first).

    A partial partition is a k-tuple of window sums with the items of each
    window. The two partitions of largest imbalance are merged again and
    again, the fullest window of one with the emptiest of the other, until one
    is left. Item lists are kept as linked pairs and read out at the end.
    """
    # a partition lists (sum, items) fullest first and leaves out its empty windows
    heap = [(-size, i, [(size, i)]) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    serial = len(sizes)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        room = k - len(a)
        if len(b) <= room:
            merged = a + b
        else:
            merged = a[: k - len(b)] if len(b) < k else []
            mixed = a[len(merged):]
            # opposing ends: the emptiest windows of one take the fullest of the other
            mixed += [(0, None)] * (len(b) - len(mixed))
            merged = merged + [(x[0] + y[0], (x[1], y[1])) for x, y in zip(reversed(mixed), b)]
        merged.sort(key=lambda w: -w[0])
        low = merged[-1][0] if len(merged) == k else 0
        heapq.heappush(heap, (-(merged[0][0] - low), serial, merged))
        serial += 1
    out = []
    for _, tree in heap[0][2] if heap else []:
        items, todo = [], [tree]
        while todo:
            x = todo.pop()
            if isinstance(x, tuple):
                todo.extend(x)
            elif x is not None:
                items.append(x)
        out.append(items)
    return out


def pack_block(sizes: list[int], capacity: int) -> list[list[int]]:
    """Windows of at most ``capacity``; their number rises while one is too full."""
    if not sizes:
        return []
    if max(sizes) > capacity:
        raise ValueError("an item is larger than the capacity")
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        windows = differencing(sizes, k)
        fullest = max(sum(sizes[i] for i in w) for w in windows)
        if fullest <= capacity:
            return windows
        k = max(k + 1, k * fullest // capacity)


#: What Arrow splits: ASCII capitals become small (as the tokenizer makes them) and line ends become spaces.
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[65:91] += 32
_PLAIN[10] = 32
_LETTER, _MARK = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[97:123] = True
_MARK[list(b".,;:!?")] = True


def parts_of(texts: pa.Array) -> pa.LargeListArray:
    """The space-separated parts of each text, marks parted from the letters before them.

    The tokenizer drops white space, never joins characters across it, and
    parts letters from marks itself, so none of this changes the ids.
    """
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    plain = _PLAIN[np.frombuffer(data or b"", np.uint8)[offsets[0] : offsets[-1]]]
    at = np.flatnonzero(_LETTER[plain[:-1]] & _MARK[plain[1:]]) + 1
    offsets = offsets - offsets[0]
    offsets = offsets + np.searchsorted(at, offsets)
    plain = np.insert(plain, at, 32)
    return pc.split_pattern(pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(offsets), pa.py_buffer(plain)), " ")


#: Bytes of token ids that a Python worker remembers, and of text that it lays out at a time.
CACHE_BYTES, SLICE_BYTES = 192_000_000, 4_000_000


class WordCache:
    """Token ids of texts, word by word.

    Arrow finds the different parts of a batch; only these are looked up or
    tokenized, and numpy lays their ids out in text order. Remembered parts are
    bounded in bytes by two generations: a full young one replaces the old one,
    and parts met in the old one move to the young one. Parts longer than
    ``longest`` characters are not remembered.
    """

    def __init__(self, path: str, limit_bytes: int = CACHE_BYTES, longest: int = 64):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        named = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(named.values(), default=0) + 1, bool)  # ids that close a word
        for token, i in named.items():
            self.closes[i] = bool(suffix) and token.endswith(suffix)
        self.limit, self.longest = limit_bytes // 2, longest
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.used = 0

    def _keep(self, found: dict[str, bytes]) -> None:
        """Remember some thousand parts; two objects and a place in the dictionary take about 200 bytes."""
        for p in [p for p in found if len(p) > self.longest]:
            del found[p]
        size = 200 * len(found) + sum(map(len, found)) + sum(map(len, found.values()))
        if self.used + size > self.limit:
            self.young, self.old, self.used = {}, self.young, 0
        if size <= self.limit:
            self.young |= found
            self.used += size

    def _encoded(self, parts: list[str]) -> dict[str, bytes]:
        """Ids of different parts: those of letters in one call, white space between.

        Such a part is one word of the encoding, closed by an id with the
        end-of-word suffix. Should the closed words not be as many as the parts
        (and for all other parts), each is encoded by itself.
        """
        words, rest = [p for p in parts if p.isalpha()], [p for p in parts if not p.isalpha()]
        known: dict[str, bytes] = {}
        if words:
            e = self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0]
            ids = np.array(e.ids, "<u4")
            ends = (np.flatnonzero(self.closes[ids]) * 4 + 4).tolist()
            if len(ends) == len(words) and ends[-1] == 4 * len(ids):
                known |= zip(words, map(ids.tobytes().__getitem__, map(slice, [0, *ends[:-1]], ends)))
            else:
                rest = parts
        if rest:
            encoded = self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)
            known |= zip(rest, [array("I", e.ids).tobytes() for e in encoded])
        return known

    def _ids_of_parts(self, parts: list[str]) -> list[bytes]:
        found: list[bytes | None] = list(map(self.young.get, parts))
        missing = [i for i, ids in enumerate(found) if ids is None]
        for at in range(0, len(missing), 4_000):
            some = missing[at : at + 4_000]
            known = {parts[i]: ids for i in some if (ids := self.old.get(parts[i])) is not None}
            known |= self._encoded([parts[i] for i in some if parts[i] not in known])
            for i in some:
                found[i] = known[parts[i]]
            self._keep(known)
        return found

    def ids(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each closed by ``end_id``, and the place where each text's ids end."""
        split = parts_of(texts)
        coded = split.flatten().dictionary_encode()
        ids = self._ids_of_parts(coded.dictionary.to_pylist())
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids) + array("I", [end_id]).tobytes(), "<u4")
        # the end id is one more part, after the last of each text
        ends = np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))
        order = np.insert(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), ends, len(ids))
        sizes = np.append(sizes, 1)
        starts = np.cumsum(sizes) - sizes
        lengths = sizes[order]
        done = np.cumsum(lengths)
        out = flat[np.repeat(starts[order] - (done - lengths), lengths) + np.arange(done[-1] if len(done) else 0)]
        return out, done[ends + np.arange(len(ends))]


@functools.lru_cache(maxsize=1)
def word_cache(path: str, limit_bytes: int) -> WordCache:
    """One cache per Python worker, kept from task to task."""
    return WordCache(path, limit_bytes)


def slices(texts: pa.Array, most_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs [first, last) of texts of about ``most_bytes`` together, one text at least."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    first = 0
    while first < len(texts):
        last = first + max(1, int(np.searchsorted(np.cumsum(sizes[first:]), most_bytes)))
        yield first, min(last, len(texts))
        first = last


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 2048,
    piece: int = 512,
    block_windows: int = 48,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    cache_bytes: int = CACHE_BYTES,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """Cut documents into pieces and place every piece in a sequence.

    A document's ids are those of its text and ``end_id``. Whole runs of
    ``capacity`` ids are sequences by themselves; what is left is cut into
    pieces of at most ``piece`` ids. Each task gathers pieces until they would
    fill ``block_windows`` sequences, splits that block by differencing and
    goes on, so memory is bounded by a block, nothing is shuffled, and a lost
    task is redone alone. At most one block a task is part full.

    Null text: as empty (one id). Null and repeated ids are kept as they are.
    An empty table gives no rows. ``sequence_tokens`` is the sequence's fill.
    """
    if piece > capacity:
        raise ValueError("piece must not exceed capacity")

    schema = pa.schema([(c, pa.string() if kind == "string" else pa.int64()) for c, kind in map(str.split, PIECE_SCHEMA.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_caches_of("packing")
        words = word_cache(tokenizer, cache_bytes)
        keeps_cache("packing", word_cache.cache_clear)
        task = TaskContext.get()
        base = (task.partitionId() if task else 0) << 33
        serial = 0
        pending: list[tuple] = []
        filled = 0
        done: list[tuple] = []  # rows ready to go out

        def flush():
            nonlocal pending, filled, serial
            for window in pack_block([p[2] for p in pending], capacity):
                at = 0
                total = sum(pending[i][2] for i in window)
                for i in window:
                    done.append((*pending[i], base + serial, at, total))
                    at += pending[i][2]
                serial += 1
            pending, filled = [], 0

        def frame():
            nonlocal done
            rows, done = done, []
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        for batch in batches:
            texts = batch.column("text")
            for first, last in slices(texts, slice_bytes):
                ids, ends = words.ids(texts[first:last], end_id)
                at = 0
                for doc_id, last_id in zip(batch.column("doc_id")[first:last].to_pylist(), ends.tolist()):
                    own, at = memoryview(ids[at:last_id]).cast("B"), last_id
                    n = len(own) // 4
                    for start in range(0, n - n % capacity, capacity):
                        crc = zlib.crc32(own[4 * start : 4 * (start + capacity)])
                        done.append((doc_id, start, capacity, crc, n, base + serial, 0, capacity))
                        serial += 1
                    for start in range(n - n % capacity, n, piece):
                        length = min(piece, n - start)
                        pending.append((doc_id, start, length, zlib.crc32(own[4 * start : 4 * (start + length)]), n))
                        filled += length
                    if filled >= block_windows * capacity:
                        flush()
                if len(done) >= 20_000:
                    yield frame()
        flush()
        if done:
            yield frame()
        free_memory()

    rows = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType
    return rows.mapInArrow(run, PIECE_SCHEMA).withColumn("doc_id", F.col("doc_id").cast(kind))

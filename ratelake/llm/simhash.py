"""Near-duplicates by SimHash, found with a byte-position inverted index and count filtering.

A fingerprint is eight positional bytes. Fingerprints that differ in at most
``d`` bits differ in at most ``d`` bytes, so they share at least ``8 - d``
positional bytes: that is the count a pair must reach. The index lists
fingerprints under sets of that many positional bytes (lists of one byte would
hold every 256th fingerprint, and their pairs would grow with the square of
the corpus). Inside a list the shared bytes of a pair are tallied; the pair
counts in the first of its lists alone, and is kept if its bits differ in few
enough places.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelake.llm.common import Scratch, small
from ratelake.llm.near_dup import components

_SPACE = re.compile(rb"[\x20\x09-\x0D]")
SEED = 42
BYTES = 8
#: Longest posting list whose pairs are met; members of longer ones meet in hubs.
LONGEST_LIST = 64
#: Fingerprints whose postings one task makes.
TASK_ROWS = 50_000


def word_runs(data: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """Words of a text in runs of about ``size`` bytes, so a very long text is never split at once."""
    at = 0
    while at < len(data):
        cut = _SPACE.search(data, at + size) if at + size < len(data) else None
        end = cut.start() if cut else len(data)
        yield data[at:end].lower().split()  # bytes: A-Z and ASCII white space alone
        at = end


def simhash(data: bytes | None, words: int = 4) -> int:
    """64-bit fingerprint of a UTF-8 text: bit set if set in over half of the shingles' hashes."""
    ones, n, carry = np.zeros(64, np.int64), 0, []
    digest = xxhash.xxh64_intdigest

    def add(hashes: list[int]) -> None:
        nonlocal n
        bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        np.add(ones, bits.sum(axis=0, dtype=np.int64), out=ones)
        n += len(hashes)

    for run in word_runs(data or b""):
        w = carry + run
        for first in range(0, len(w) - words + 1, 65_536):
            last = min(first + 65_536, len(w) - words + 1)
            add([digest(b" ".join(w[i : i + words]), SEED) for i in range(first, last)])
        carry = w[max(0, len(w) - words + 1) :]
    if not n and carry:
        add([digest(b" ".join(carry), SEED)])
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big") if n else 0


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4) -> DataFrame:
    """doc_id, fp (the fingerprint's 64 bits as a signed long) of every row."""

    @F.pandas_udf("long")
    def fingerprint(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([simhash(t, words) for t in texts], np.uint64).view(np.int64))

    return docs.select(F.col(id_col).alias("doc_id"), fingerprint(F.col(text_col).cast("binary")).alias("fp"))


def _byte(col: str, position: int) -> Column:
    return F.shiftrightunsigned(F.col(col), 8 * position).bitwiseAND(F.lit(255))


def postings(col: str, shared: int) -> Column:
    """Array of the posting lists of a fingerprint: struct(key, last position, bit mask of the positions).

    The key is the number of the position set and its bytes, so lists of
    different sets never meet; ``shared`` bytes of eight fit a long with it up
    to seven bytes.
    """
    lists = []
    for number, places in enumerate(itertools.combinations(range(BYTES), shared)):
        key = F.lit(number).cast("long")
        for p in places:
            key = F.shiftleft(key, 8).bitwiseOR(_byte(col, p))
        lists.append(F.struct(key.alias("key"), F.lit(places[-1]).alias("last"), F.lit(sum(1 << p for p in places)).alias("places")))
    return F.array(*lists)


def tally(a: str, b: str, last: Column) -> Column:
    """Positional bytes that two fingerprints share up to position ``last``."""
    differs = F.col(a).bitwiseXOR(F.col(b))
    total = F.lit(0)
    for p in range(BYTES):
        same = F.shiftrightunsigned(differs, 8 * p).bitwiseAND(F.lit(255)) == 0
        total = total + F.when(same & (F.lit(p) <= last), 1).otherwise(0)
    return total


def links(nodes: DataFrame, bits: int = 4, longest: int = LONGEST_LIST, tables: Scratch | None = None) -> DataFrame:
    """(a, b): links between different fingerprints (column fp, distinct) that connect all pairs within ``bits``.

    Every pair of a list of at most ``longest`` members is met. In a longer
    list (a dense group of near copies) pairs aren't: a pair within ``bits``
    has a common point at most half as far from both, and differs from it only
    outside the list's bytes. So each member names all points so near that keep
    the bytes of one of its long lists, and the members that name a point are
    linked to the least of them. That is exact, costs a bounded number of rows
    a fingerprint whatever the length of the list, and a point has a bounded
    number of members. Only links that are needed to connect such members are
    returned, not all their pairs.
    """
    if not 2 <= bits <= 6 or bits % 2:
        raise ValueError("bits must be 2, 4 or 6")
    tables = tables or Scratch(nodes.sparkSession)
    shared = BYTES - bits
    # a fingerprint is 8 bytes and makes up to 70 postings: tasks by rows, not by bytes
    nodes = tables.write(nodes.repartition(max(1, -(-nodes.count() // TASK_ROWS)), "fp"), "simhash-nodes")
    posted = nodes.select("fp", F.explode(postings("fp", shared)).alias("p")).select("fp", "p.*")
    lists = posted.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    lists = tables.write(lists, "simhash-lists")
    met = tables.write(posted.join(small(lists), "key"), "simhash-postings")

    short = met.where(F.col("n") <= longest)
    a = short.select("key", "last", F.col("fp").alias("a"))
    b = short.select("key", F.col("fp").alias("b"))
    counted = tally("a", "b", F.col("last")) == shared  # the first shared bytes are this list's: counted once
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits
    found = a.join(b, (a["key"] == b["key"]) & (F.col("a") < F.col("b")) & counted & near).select("a", "b")

    dense = met.where(F.col("n") > longest).groupBy("fp").agg(F.collect_set("places").alias("places"))
    flips = [0] + [sum(1 << i for i in c) for r in range(1, bits // 2 + 1) for c in itertools.combinations(range(64), r)]
    touched = [sum({1 << (i // 8) for i in range(64) if f >> i & 1}) for f in flips]

    def points(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        masks, bytes_of = np.array(flips, np.uint64), np.array(touched, np.int64)
        for batch in batches:
            for fp, places in zip(batch["fp"], batch["places"]):
                keeps = ((bytes_of[:, None] & np.asarray(places, np.int64)) == 0).any(axis=1)
                named = np.int64(fp).view(np.uint64) ^ masks[keeps]
                yield pd.DataFrame({"point": named.view(np.int64), "fp": np.full(len(named), fp, np.int64)})

    named = dense.mapInPandas(points, "point long, fp long")
    least = named.withColumn("a", F.min("fp").over(Window.partitionBy("point")))
    hubs = least.where(F.col("a") < F.col("fp")).select("a", F.col("fp").alias("b"))
    return tables.write(found.union(hubs).distinct(), "simhash-links")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    bits: int = 4,
    words: int = 4,
    longest: int = LONGEST_LIST,
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id, n_component for every row.

    Fingerprints within ``bits`` differing bits are linked; ``component_id`` is
    the smallest doc_id among the rows that links reach, ``n_component`` their
    number. Rows of one fingerprint are one node: copies cost nothing in the
    index.

    Null and empty texts, and texts of white space, have no words: fingerprint
    zero, linked like any other. A text of fewer than ``words`` words is one
    shingle. Null ids come last in the choice of component_id (a component of
    null ids only has null); repeated ids are rows like any other. An empty
    table gives no rows; other columns are not read.
    """
    tables = Scratch(docs.sparkSession)
    base = tables.write(fingerprints(docs, id_col, text_col, words), "fingerprints")
    nodes = base.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("rows"))
    nodes = tables.write(nodes, "fingerprint-nodes")
    comp = components(links(nodes.select("fp"), bits, longest, tables), tables.write)
    comp = comp.union(comp.select(F.col("comp").alias("node"), "comp").distinct())
    # only fingerprints of several rows or of a component need a look-up: the rest are alone
    placed = nodes.join(comp, F.col("fp") == F.col("node"), "left").where("node IS NOT NULL OR rows > 1")
    placed = tables.write(placed.select("fp", F.coalesce("comp", "fp").alias("comp"), "least", "rows"), "placed-fingerprints")
    labels = placed.groupBy("comp").agg(F.min("least").alias("component_id"), F.sum("rows").alias("n_component"))
    labels = tables.write(placed.select("fp", "comp").join(labels, "comp").select("fp", "component_id", "n_component"), "component-labels")
    tables.clear("fingerprints", "component-labels")
    out = base.join(small(labels), "fp", "left")
    alone = F.col("n_component").isNull()
    return out.select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("n_component", F.lit(1)).alias("n_component"),
    )


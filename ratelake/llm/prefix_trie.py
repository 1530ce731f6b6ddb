"""Conversation prefix trie: subtree totals by time-forward processing (Chiang et al. 1995).

A node is a distinct prefix of turns, known by its depth and a 128-bit key of
the prefix. Members, children keys and ending conversations are grouped; what a
subtree adds up (leaves, saved tokens) is passed from child to parent: nodes
are sorted by reverse level order and each takes the messages addressed to it
from a priority queue and sends its own total on, so a tree of any shape needs
one pass and the queue, which spills to disk, holds only what is under way.
The trie is cut at its topmost nodes of bounded weight: what is below such a
root is one shard; the totals of the shard roots then go to the nodes above,
cut and processed in the same way until few are left.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelake.llm.common import Scratch, small

KEY = ["depth", "k1", "k2"]
#: Ids in one row of the ordered lists that are hashed.
RUN_OF_IDS = 4096


class MessageQueue:
    """Priority queue of messages (place, leaves, saved), least place first; sorted runs go to disk.

    At most ``limit`` messages are in memory; a run on disk is an unnamed file
    of this task alone, read back one message at a time.
    """

    def __init__(self, limit: int = 200_000):
        self.limit = limit
        self.heap: list[tuple] = []
        self.runs: list[tuple] = []  # heap of (first message, number, file)
        self.serial = 0

    def push(self, message: tuple) -> None:
        heapq.heappush(self.heap, message)
        if len(self.heap) > self.limit:
            self.heap.sort()
            file = tempfile.TemporaryFile()
            for m in self.heap[self.limit // 2 :]:  # the near half stays
                pickle.dump(m, file)
            file.seek(0)
            del self.heap[self.limit // 2 :]
            self._next(file)

    def _next(self, file) -> None:
        try:
            first = pickle.load(file)
        except EOFError:
            file.close()
            return
        self.serial += 1
        heapq.heappush(self.runs, (first, self.serial, file))

    def take(self, place: tuple) -> Iterator[tuple]:
        """All messages to ``place``; none may be left for an earlier one."""
        while True:
            here = self.heap and self.heap[0][0] <= place
            there = self.runs and self.runs[0][0][0] <= place
            if here:
                yield heapq.heappop(self.heap)
            elif there:
                message, _, file = heapq.heappop(self.runs)
                self._next(file)
                yield message
            else:
                return


def scan(df: DataFrame, key: str, order: list[Column], hashes: tuple[str, str] | None, tables: Scratch, label: str, drop: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with ``rank`` (1, 2, ... inside ``key``, by ``order``) and, given ``hashes``, k1, k2: their running xor.

    The rows are sorted over range partitions, so a key of very many rows is
    spread. Each partition counts by itself; a key that goes on from one
    partition into the next gets the totals before it added. Those totals are
    at most two rows a partition and are broadcast. Columns in ``drop`` only order.
    """
    kept = [c for c in df.columns if c not in drop]
    fields = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    schema = ", ".join(f"`{c}` {fields[c]}" for c in kept) + ", rank long, k1 long, k2 long, part int"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, last, count, totals = TaskContext.get().partitionId(), None, 0, np.zeros(2, np.int64)
        for batch in batches:
            if not len(batch):
                continue
            ids = batch[key].to_numpy()
            new = np.concatenate([[ids[0] != last], ids[1:] != ids[:-1]])
            starts = np.flatnonzero(new)
            group = np.cumsum(new)  # 0: goes on from the batch before
            first = np.concatenate([[0], starts])[group]
            rank = np.arange(len(ids)) - first + 1 + np.where(group == 0, count, 0)
            out = batch.assign(rank=rank, k1=0, k2=0, part=part)
            if hashes:
                for i, c in enumerate(hashes):
                    xor = np.bitwise_xor.accumulate(batch[c].to_numpy(np.int64))
                    before = np.where(group == 0, totals[i], np.where(first > 0, xor[first - 1], 0))
                    out[f"k{i + 1}"] = xor ^ before
                totals = np.array([out["k1"].iloc[-1], out["k2"].iloc[-1]], np.int64)
            last, count = ids[-1], int(rank[-1])
            yield out

    by = [F.col(key), *order]
    counted = df.repartitionByRange(*by).sortWithinPartitions(*by).select(*kept)
    counted = tables.write(counted.mapInPandas(run, schema), label)
    spread = counted.groupBy(key, "part").agg(F.max(F.struct("rank", "k1", "k2")).alias("t"))
    several = spread.groupBy(key).agg(F.count(F.lit(1)).alias("parts")).where("parts > 1")
    # a key in several partitions is the last of one and the first of the next: two rows a partition at most
    spread = spread.join(small(tables.write(several.select(key), f"{label}-spread")), key)
    before = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spread = spread.select(
        F.col(key).alias("__rl_key"),
        F.col("part").alias("__rl_part"),
        F.coalesce(F.sum("t.rank").over(before), F.lit(0)).alias("__rl_rank"),
        *[F.coalesce(F.bit_xor(f"t.{k}").over(before), F.lit(0)).alias(f"__rl_{k}") for k in ("k1", "k2")],
    )
    spread = tables.write(spread, f"{label}-before")
    joined = counted.join(F.broadcast(spread), (F.col(key) == F.col("__rl_key")) & (F.col("part") == F.col("__rl_part")), "left")
    zero = F.lit(0)
    return joined.select(
        *kept,
        (F.col("rank") + F.coalesce("__rl_rank", zero)).alias("rank"),
        *[F.col(k).bitwiseXOR(F.coalesce(f"__rl_{k}", zero)).alias(k) for k in (("k1", "k2") if hashes else ())],
    )


def rebuilt(turns: DataFrame, tables: Scratch, every: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations whose head is replaced: (steps, convs).

    Conversation c gets the first h turns of conversation c - c % ``every``,
    h = crc32(decimal c) % ``most`` (all if it has fewer, none if it is
    absent), then its own turns after its first h. steps: conv_id, depth (from
    1), len, h1, h2 (hash of depth, role and text), tokens of the text; convs:
    conv_id, len. Turns are ordered by turn (null first), then role and text.
    """
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    ranked = scan(rows, "conv_id", [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")], None, tables, "ranked-turns", drop=("turn",))
    words = F.size(F.expr(r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)"))
    ranked = ranked.select("conv_id", "rank", words.cast("long").alias("tokens"), *_hashes("role", "text"))
    ranked = tables.write(ranked, "hashed-turns")

    sizes = ranked.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own"))
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    sizes = tables.write(sizes.select("conv_id", "own", head.alias("h"), (F.col("conv_id") - F.col("conv_id") % every).alias("base")), "conversations")
    bases = sizes.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("base"), F.col("own").alias("base_own"))
    convs = sizes.join(bases, "base", "left").withColumn("kept", F.least("h", F.coalesce("base_own", F.lit(0))))
    convs = convs.select("conv_id", "base", "h", "kept", (F.col("kept") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("len"))
    convs = tables.write(convs, "rebuilt-conversations")

    known = small(convs.select("conv_id", "h", "kept", "len"))
    own = ranked.join(known, "conv_id").where("rank > h").withColumn("depth", F.col("rank") - F.col("h") + F.col("kept"))
    heads = ranked.where((F.col("conv_id") % every == 0) & (F.col("rank") < most)).withColumnRenamed("conv_id", "base")
    heads = heads.join(convs.where("kept > 0").select("base", "conv_id", "kept", "len"), "base").where("rank <= kept")
    cols = ["conv_id", "depth", "len", "tokens", "t1", "t2"]
    steps = own.select(cols).unionByName(heads.withColumnRenamed("rank", "depth").select(cols))
    return steps.select("conv_id", "depth", "len", "tokens", *_hashes("depth", "t1", "t2", names=("h1", "h2"))), convs.select("conv_id", "len")


def _hashes(*cols: str, names: tuple[str, str] = ("t1", "t2")) -> list[Column]:
    """Two longs that hash the columns, 128 bits of an md5 over their lengths and values."""
    parts = [p.cast("string") for c in cols for p in (F.octet_length(F.col(c).cast("string")), F.col(c))]
    hexed = F.md5(F.concat_ws(" ", *parts))
    halves = (F.substring(hexed, 1, 16), F.substring(hexed, 17, 16))
    return [F.conv(h, 16, -10).cast("long").alias(n) for h, n in zip(halves, names)]


def _totals(nodes: DataFrame, limit: int) -> DataFrame:
    """Subtree totals of a table of whole shards, one pass over each partition.

    nodes: depth, k1, k2, p1, p2, shard, top (its parent is elsewhere), and
    what came from below: leaves, saved, children. Returns the nodes' keys with
    n_children, n_leaves, saved_tokens, top, p1, p2.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        queue = MessageQueue(limit)
        names = ["depth", "k1", "k2", "p1", "p2", "top", "own", "leaves", "saved", "children"]
        for batch in batches:
            out = []
            for depth, k1, k2, p1, p2, top, own, leaves, saved, children in zip(*(batch[c].tolist() for c in names)):
                saved += own
                for _, below, tokens in queue.take((-depth, k1, k2)):
                    leaves += below
                    saved += tokens
                    children += 1
                leaves = leaves if children else 1
                if not top:
                    queue.push(((1 - depth, p1, p2), leaves, saved))
                out.append((depth, k1, k2, p1, p2, top, children, leaves, saved))
            yield pd.DataFrame(out, columns=["depth", "k1", "k2", "p1", "p2", "top", "n_children", "n_leaves", "saved_tokens"])

    schema = "depth long, k1 long, k2 long, p1 long, p2 long, top boolean, n_children long, n_leaves long, saved_tokens long"
    level = [F.col("depth").desc(), F.col("k1"), F.col("k2")]
    nodes = nodes.select("shard", *KEY, "p1", "p2", "top", "own", "leaves", "saved", "children")
    return nodes.repartition("shard").sortWithinPartitions(*level).mapInPandas(run, schema)


def subtree_totals(nodes: DataFrame, steps: DataFrame, shard_rows: int, tables: Scratch, limit: int = 200_000) -> DataFrame:
    """depth, k1, k2, n_children, n_leaves, saved_tokens of all nodes.

    A node's weight is the number of turns that its members have from there on,
    so at most that many nodes are below it. Round by round the topmost nodes
    whose weight is within a bound become shard roots; what is below them and
    not yet done is a shard of bounded size. Roots' totals are added up by
    parent (map side first, so a parent of very many children is no hot key)
    and the next round has a larger bound. The last round holds the few nodes
    left. A conversation of more turns than ``shard_rows`` makes shards as long
    as it is, which the spilling queue holds.
    """
    todo = nodes.withColumns({c: F.lit(0).cast("long") for c in ("leaves", "saved", "children")})
    longest, left = nodes.agg(F.max("depth"), F.count(F.lit(1))).first()
    if not left:
        return nodes.select(*KEY, *[F.lit(0).cast("long").alias(c) for c in ("n_children", "n_leaves", "saved_tokens")])
    factor, bound, parts = max(2, shard_rows // max(1, longest)), shard_rows, []
    weights = nodes.select(*KEY, "weight", "conv_id")
    paths = tables.write(steps.select("conv_id", *KEY).join(weights.drop("conv_id"), KEY), "weighted-steps")
    while True:
        last = left <= shard_rows
        if last:
            placed = todo.withColumn("shard", F.lit(0).cast("long")).withColumn("top", F.col("depth") == 0)
        else:
            # the topmost light node on the path of a node's first member names its shard
            roots = paths.where(F.col("weight") <= bound).groupBy("conv_id").agg(F.min(F.struct(*KEY)).alias("r"))
            placed = todo.where(F.col("weight") <= bound).join(roots, "conv_id")
            placed = placed.withColumn("top", (F.col("depth") == F.col("r.depth"))).withColumn("shard", F.xxhash64("r"))
        done = tables.write(_totals(placed, limit), "subtree-totals")
        parts.append(done.select(*KEY, "n_children", "n_leaves", "saved_tokens"))
        if last:
            break
        sent = done.where("top").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"))
        sent = sent.agg(F.sum("n_leaves").alias("more"), F.sum("saved_tokens").alias("tokens"), F.count(F.lit(1)).alias("below"))
        above = todo.where(F.col("weight") > bound).join(sent, KEY, "left")
        for total, new in (("leaves", "more"), ("saved", "tokens"), ("children", "below")):
            above = above.withColumn(total, F.col(total) + F.coalesce(new, F.lit(0)))
        todo = tables.write(above.drop("more", "tokens", "below"), "nodes-above")
        left = todo.count()
        bound *= factor
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _ends(ends: DataFrame, tables: Scratch) -> DataFrame:
    """depth, k1, k2, ends_sha256 of the conversations (conv_id) that end at a node, in order of id.

    The ids are sorted over range partitions and joined in runs, so a node at
    which very many conversations end is spread; then each node's runs go
    through one hash state in order, a row at a time.
    """

    def joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: list[list] = []
            for *key, conv_id in zip(*(batch[c].tolist() for c in (*KEY, "conv_id"))):
                if not out or out[-1][0] != key or len(out[-1][1]) == RUN_OF_IDS:
                    out.append([key, []])
                out[-1][1].append(conv_id)
            rows = [(*key, ids[0], ",".join(map(str, ids))) for key, ids in out]
            yield pd.DataFrame(rows, columns=[*KEY, "first", "ids"])

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, state = None, None
        for batch in batches:
            out = []
            for *key, ids in zip(*(batch[c].tolist() for c in (*KEY, "ids"))):
                if key != last:
                    if last is not None:
                        out.append((*last, state.hexdigest()))
                    last, state = key, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pd.DataFrame(out, columns=[*KEY, "ends_sha256"])
        if last is not None:
            yield pd.DataFrame([(*last, state.hexdigest())], columns=[*KEY, "ends_sha256"])

    ends = ends.repartitionByRange(*KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id").select(*KEY, "conv_id")
    runs = ends.mapInPandas(joined, "depth long, k1 long, k2 long, first long, ids string")
    runs = runs.repartition(*KEY).sortWithinPartitions(*KEY, "first")
    return tables.write(runs.mapInPandas(hashed, "depth long, k1 long, k2 long, ends_sha256 string"), "node-ends")


def prefix_trie(conversations: DataFrame, shard_rows: int = 20_000, queue_limit: int = 200_000) -> DataFrame:
    """One row per node of the trie of rebuilt conversations (see ``rebuilt``).

    conv_id (smallest member), depth, parent_conv_id (its parent's conv_id; the
    root has null), n_convs (members), n_children, n_leaves (childless nodes in
    its subtree, itself included), saved_tokens (sum over its subtree of
    (members - 1) x words of the node's last text), ends_sha256 (of the
    members' ids that end here, ascending, comma-joined; none: of the empty
    string).

    Null role or text counts as empty; turns that are equal in turn are ordered
    by role and text, equal rows are as many turns. Rows of a null conv_id
    belong to no conversation and are left out. A conversation that is rebuilt
    without turns ends at the root. An empty table has no nodes, not even a
    root. Columns besides conv_id, turn, role and text are not read.
    """
    tables = Scratch(conversations.sparkSession)
    steps, convs = rebuilt(conversations, tables)
    steps = tables.write(scan(steps, "conv_id", [F.col("depth")], ("h1", "h2"), tables, "prefix-keys").drop("rank"), "steps")
    member = [F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")]
    zero = F.lit(0).cast("long")
    nodes = steps.groupBy(*KEY).agg(
        *member,
        F.sum(F.col("len") - F.col("depth") + 1).alias("weight"),
        F.first("tokens").alias("tokens"),
        F.first(F.col("k1").bitwiseXOR(F.col("h1"))).alias("p1"),
        F.first(F.col("k2").bitwiseXOR(F.col("h2"))).alias("p2"),
    )
    root = convs.agg(*member, F.sum(F.col("len") + 1).alias("weight")).where("n_convs > 0")
    root = root.select(*[zero.alias(c) for c in KEY], *root.columns, *[zero.alias(c) for c in ("tokens", "p1", "p2")])
    nodes = nodes.unionByName(root).withColumn("own", (F.col("n_convs") - 1) * F.col("tokens")).drop("tokens")
    nodes = tables.write(nodes, "trie-nodes")
    from_root = convs.select("conv_id", *[zero.alias(c) for c in KEY])
    paths = steps.select("conv_id", *KEY).unionByName(from_root)
    totals = subtree_totals(nodes, paths, shard_rows, tables, queue_limit)

    ends = steps.where("depth = len").select("conv_id", *KEY)
    ends = _ends(ends.unionByName(from_root.join(convs.where("len = 0").select("conv_id"), "conv_id", "left_semi")), tables)
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(parents, ["depth", "p1", "p2"], "left").join(totals, KEY).join(ends, KEY, "left")
    out = out.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
    out = tables.write(out, "prefix-trie")
    tables.clear("prefix-trie")
    return out

"""Sharding by jump consistent hashing (Lamping & Veach 2014).

The shard of a row depends on its key and on the number of shards alone: no
ring table, no state. Appending a shard moves only the rows that the new shard
receives, on average 1/(n+1) of all rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratelake.llm.common import materialize

_STEP = np.uint64(2862933555777941757)


def jump_hash(keys: np.ndarray, n: int) -> np.ndarray:
    """Bucket in ``[0, n)`` of each unsigned 64-bit key (all keys advance together)."""
    key = keys.astype(np.uint64, copy=True)
    bucket = np.zeros(len(key), np.int64)
    live = np.arange(len(key))
    while len(live):
        k = key[live] * _STEP + np.uint64(1)
        key[live] = k
        jump = ((bucket[live] + 1) * (2.0**31 / ((k >> np.uint64(33)).astype(np.float64) + 1.0))).astype(np.int64)
        inside = jump < n
        live = live[inside]
        bucket[live] = jump[inside]
    return bucket


def with_shard(df: DataFrame, key: str, n_shards: int, shard: str = "shard", grown: str | None = None) -> DataFrame:
    """Add the shard of ``key`` (any type; hashed to 64 bits by Spark first).

    Equal keys share a shard; a null key is a key like any other. ``grown``
    names an extra column with the shard under ``n_shards + 1``.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")

    @F.pandas_udf("struct<a:int,b:int>")
    def place(h: pd.Series) -> pd.DataFrame:
        k = h.to_numpy(np.int64).view(np.uint64)
        return pd.DataFrame({"a": jump_hash(k, n_shards).astype(np.int32), "b": jump_hash(k, n_shards + 1).astype(np.int32)})

    placed = df.withColumn("__rl_place", place(F.xxhash64(F.col(key))))
    placed = placed.withColumn(shard, F.col("__rl_place.a"))
    if grown:
        placed = placed.withColumn(grown, F.col("__rl_place.b"))
    return placed.drop("__rl_place")


def with_slots(df: DataFrame, shard: str, order: list[str], slot: str = "slot", buckets: int = 1024) -> DataFrame:
    """Number the rows of each shard from 0 without gaps.

    Rows of a shard are spread over ``buckets`` hash buckets of the ordering
    columns, numbered inside each bucket and shifted by the sizes of the
    buckets before it, so no task holds a whole shard. Rows equal in every
    column are counted before the shuffle and written out again afterwards, in
    chunks, so a row repeated very often fills no task's memory. The offsets
    are at most shards x ``buckets`` rows, which bounds the broadcast.
    """
    cols = df.columns
    counted = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__rl_n"))
    counted = counted.withColumn("__rl_b", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    counted = materialize(counted, "shard-rows")
    sizes = counted.groupBy(shard, "__rl_b").agg(F.sum("__rl_n").alias("__rl_size"))
    before = Window.partitionBy(shard).orderBy("__rl_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col(shard).alias("__rl_s"),
        F.col("__rl_b").alias("__rl_ob"),
        F.coalesce(F.sum("__rl_size").over(before), F.lit(0)).alias("__rl_base"),
    )
    inside = Window.partitionBy(shard, "__rl_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("__rl_first", F.coalesce(F.sum("__rl_n").over(inside), F.lit(0)))
    placed = placed.join(F.broadcast(offsets), (F.col(shard) == F.col("__rl_s")) & (F.col("__rl_b") == F.col("__rl_ob")))
    chunk = 65_536
    start = F.col("__rl_base") + F.col("__rl_first")
    chunks = placed.withColumn("__rl_c", F.explode(F.expr(f"sequence(0L, (__rl_n - 1) div {chunk})")))
    each = F.explode(F.expr(f"sequence(__rl_c * {chunk}L, least(__rl_n, (__rl_c + 1) * {chunk}L) - 1)"))
    return chunks.withColumn("__rl_i", each).select(*cols, (start + F.col("__rl_i")).alias(slot))


def shard_documents(docs: DataFrame, n_shards: int = 40, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Shard, slot and grown shard of every document, by document id.

    ``size``: UTF-8 bytes plus 16. A null text has no bytes (crc32 of nothing:
    0), as an empty one. A null id is a key of its own. Repeated ids share a
    shard and have a slot each. An empty table gives no rows; columns other
    than the two named are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
    )
    rows = with_shard(rows, "doc_id", n_shards, "shard", "grown_shard")
    slotted = with_slots(rows, "shard", ["doc_id", "size", "text_crc32"])
    return slotted.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")

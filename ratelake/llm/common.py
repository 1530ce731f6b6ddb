"""Helpers shared by the corpus operators."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake.session import materialize, scratch_dir  # noqa: F401 - re-exported for the operators

#: Rows up to which a table that was written and counted may be broadcast.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Tables that one operator writes under the shared folder.

    ``clear`` deletes those its lazy result doesn't read, so a run of several
    operators doesn't pile them up.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[str, str] = {}

    def write(self, df: DataFrame, label: str) -> DataFrame:
        path = scratch_dir(self.spark, label)
        df.write.parquet(path)
        self.paths[path] = label
        return self.spark.read.parquet(path)

    def clear(self, *keep: str) -> None:
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        for path in [p for p, label in self.paths.items() if label not in keep]:
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(conf).delete(folder, True)
            del self.paths[path]


def free_memory() -> None:
    """Gives memory that this worker has freed back to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library can
        ctypes.CDLL(None).malloc_trim(0)


#: What operators keep in a Python worker from task to task: owner -> how to drop it.
_KEPT: dict[str, Callable[[], object]] = {}


def keeps_cache(owner: str, drop: Callable[[], object]) -> None:
    """Tells that ``owner`` keeps a cache in this worker."""
    _KEPT[owner] = drop


def only_caches_of(owner: str) -> None:
    """Drops the caches of other operators: a worker serves one operator after another, and caches add up."""
    others = [o for o in _KEPT if o != owner]
    for o in others:
        _KEPT.pop(o)()
    if others:
        gc.collect()
        free_memory()


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast of a *materialised* table if its counted rows allow it.

    Beyond the bound the frame is returned unhinted and Spark joins by shuffle;
    both plans give the same rows.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def crc_of_id(col: str) -> Column:
    """crc32 of an id written as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary"))


def text_key(*cols: str) -> Column:
    """16-byte key of some columns (null and empty differ).

    Used where a result depends on nothing but these columns: rows that share
    the key share the result, so repeated ids and repeated rows are harmless.
    """
    parts = []
    for c in cols:
        v = F.col(c).cast("string")
        parts.append(F.when(v.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), v)))
    return F.unhex(F.md5(F.concat_ws("\u0000", *parts)))

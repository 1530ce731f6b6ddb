"""Line dedup by site-relative frequency.

A line is boilerplate of a host if the share of the host's pages that hold it
exceeds a ratio. Pages with the same text count as one, so a page that was
copied many times doesn't make all of its own lines boilerplate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelake.llm.common import materialize, small

MAX_RATIO = 0.02
#: A line on one page is no boilerplate, whatever the ratio; from two pages on the ratio decides.
MIN_PAGES = 2
#: Hosts and lines (8 bytes each) up to which the boilerplate is broadcast.
BROADCAST_HOSTS, BROADCAST_LINES = 10_000, 2_000_000


def _lines(col: str):
    return F.split(F.col(col), "\n", -1)


def boilerplate(pages: DataFrame, max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """host, line (64-bit hash), n_pages of the lines over the ratio; pages: host, text.

    Lines are counted per host after one explode: distinct (host, line, text)
    rows of three longs, then two partial aggregations; no row carries text.
    """
    hashed = pages.where(F.col("text").isNotNull()).select("host", F.xxhash64("text").alias("page"), "text")
    totals = hashed.groupBy("host").agg(F.count_distinct("page").alias("total"))
    lines = hashed.select("host", "page", F.explode(_lines("text")).alias("line"))
    lines = lines.where(F.trim("line") != "").select("host", "page", F.xxhash64(F.trim("line")).alias("line"))
    counts = lines.distinct().groupBy("host", "line").agg(F.count(F.lit(1)).alias("n_pages"))
    common = counts.where(F.col("n_pages") >= min_pages).join(totals, "host")
    return common.where(F.col("n_pages") > F.lit(max_ratio) * F.col("total")).select("host", "line", "n_pages")


def drop_boilerplate(
    docs: DataFrame,
    host_col: str = "source",
    text_col: str = "text",
    max_ratio: float = MAX_RATIO,
    min_pages: int = MIN_PAGES,
    n_lines: str | None = None,
    n_dropped: str | None = None,
) -> DataFrame:
    """``docs`` without its boilerplate lines; every row stays, all columns stay.

    Lines are compared without the spaces around them. Blank lines are neither
    counted nor dropped. A line goes from every page of the host that has it if
    at least ``min_pages`` different pages do and their share of the host's
    different pages is above ``max_ratio``. Null text stays null; a text left
    without lines becomes empty; a null host is the host ''. ``n_lines`` and
    ``n_dropped`` name optional count columns (null text: 0).

    The drop is a map over whole texts: a host's boilerplate is one array, at
    most (lines a page) / ``max_ratio`` long whatever the host's size. It is
    broadcast if the hosts and their lines counted are few, else joined by host.
    """
    host = F.coalesce(F.col(host_col).cast("string"), F.lit(""))
    found = boilerplate(docs.select(host.alias("host"), F.col(text_col).alias("text")), max_ratio, min_pages)
    found = found.groupBy("host").agg(F.collect_list("line").alias("__rl_bad"))
    found = materialize(found.withColumnRenamed("host", "__rl_host"), "boilerplate")
    # a row is a host and its lines: both numbers bound what is broadcast
    lines = found.agg(F.sum(F.size("__rl_bad"))).first()[0] or 0
    found = small(found, BROADCAST_HOSTS) if lines <= BROADCAST_LINES else found
    out = docs.join(found, host == F.col("__rl_host"), "left")
    bad = F.coalesce("__rl_bad", F.array().cast("array<bigint>"))
    kept = F.filter("__rl_lines", lambda x: ~F.array_contains(F.col("__rl_b"), F.xxhash64(F.trim(x))) | (F.trim(x) == ""))
    out = out.withColumn("__rl_lines", _lines(text_col))
    # the page's own bad lines, by hashing: no line is looked for in the host's whole list
    here = F.array_intersect(F.transform("__rl_lines", lambda x: F.xxhash64(F.trim(x))), bad)
    out = out.withColumn("__rl_b", F.coalesce(here, F.array().cast("array<bigint>")))
    out = out.withColumn("__rl_kept", F.when(F.size("__rl_b") == 0, F.col("__rl_lines")).otherwise(kept))
    cols = [F.array_join("__rl_kept", "\n").alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    if n_lines:
        cols.append(F.coalesce(F.size("__rl_lines"), F.lit(0)).cast("long").alias(n_lines))
    if n_dropped:
        gone = F.size("__rl_lines") - F.size("__rl_kept")
        cols.append(F.coalesce(gone, F.lit(0)).cast("long").alias(n_dropped))
    return out.select(*cols)

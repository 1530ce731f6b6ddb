"""Approximate nearest neighbours: a forest of random-projection trees.

Trees are fitted on a bounded sample, every vector is indexed in a leaf of
every tree. A query opens leaves in the order of one priority queue shared by
all trees (smallest margin on the path first) until it has seen enough rows,
and the leaf members are ranked by their exact inner products, leaf by leaf, in
blocks.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelake.llm.common import materialize


class Forest:
    """``trees`` complete binary trees of ``depth`` random, median-split projections."""

    def __init__(self, sample: np.ndarray, trees: int, depth: int, seed: int):
        rng = np.random.default_rng(seed)
        inner, dim = 2**depth - 1, sample.shape[1]
        self.trees, self.depth, self.leaves = trees, depth, 2**depth
        self.planes = rng.standard_normal((trees, inner, dim))
        self.cuts = np.zeros((trees, inner))
        for t in range(trees):
            node = np.zeros(len(sample), np.int64)
            for n in range(inner):
                rows = np.flatnonzero(node == n)
                if not len(rows):
                    continue
                side = sample[rows] @ self.planes[t, n]
                scale = side.std() or 1.0  # margins of all nodes share one unit
                self.planes[t, n] /= scale
                side = side / scale
                self.cuts[t, n] = np.median(side)
                node[rows] = 2 * n + 1 + (side > self.cuts[t, n])

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Signed distance of each vector to each cut: (vectors, trees, nodes)."""
        flat = x @ self.planes.reshape(-1, x.shape[1]).T
        return flat.reshape(len(x), self.trees, -1) - self.cuts

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        right = self.margins(x) > 0
        node = np.zeros((len(x), self.trees), np.int64)
        for _ in range(self.depth):
            step = np.take_along_axis(right, node[:, :, None], 2)[:, :, 0]
            node = 2 * node + 1 + step
        return node - (self.leaves - 1)

    def search(self, margins: np.ndarray, counts: np.ndarray, rows: float, least: int) -> list[tuple[int, int]]:
        """Leaves of one query, nearest first: until their postings reach ``rows``
        and one tree alone has given ``least`` rows, or nothing is left."""
        inner = self.leaves - 1
        queue = [(0.0, t, 0) for t in range(self.trees)]
        found, seen, by_tree = [], 0, [0] * self.trees
        while queue and (seen < rows or max(by_tree) < least):
            far, t, n = heapq.heappop(queue)
            while n < inner:
                m = margins[t, n]
                near, other = (2 * n + 2, 2 * n + 1) if m > 0 else (2 * n + 1, 2 * n + 2)
                heapq.heappush(queue, (max(far, abs(m)), t, other))
                n = near
            leaf = n - inner
            if counts[t, leaf]:
                found.append((t, leaf))
                seen += counts[t, leaf]
                by_tree[t] += counts[t, leaf]
        return found


def usable(vector: Column, dim: int | None = None) -> Column:
    """True for vectors without null or non-finite components that are not all zero."""
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    ok = vector.isNotNull() & ~bad & F.exists(vector, lambda v: v != 0)
    return F.coalesce(ok & (F.size(vector) == dim) if dim else ok, F.lit(False))


def _top_of_block(k: int):
    def top(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        right = right.sort_values("vec_id", kind="stable")
        ids = right["vec_id"].to_numpy(np.int64)
        v = np.stack(right["embedding"].to_list()).astype(np.float64)
        own = left["query_id"].to_numpy(np.int64)
        q = np.stack(left["query"].to_list()).astype(np.float64)
        out_q, out_v = [], []
        first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
        ends = np.append(first[1:], len(ids))
        for at in range(0, len(q), 512):  # bounds the score matrix
            # rounding makes equal vectors tie; members stand in id order
            rows = np.round(q[at : at + 512] @ v.T, 12)
            rows[own[at : at + 512, None] == ids[None, :]] = -np.inf
            s = np.maximum.reduceat(rows, first, axis=1) if len(first) < len(ids) else rows  # an id counts with its best vector
            kth = np.partition(s, -k, axis=1)[:, -k] if len(first) > k else np.full(len(s), -np.inf)
            for i in range(len(s)):
                near = np.flatnonzero((s[i] >= kth[i]) & (s[i] > -np.inf))
                near = near[np.argsort(-s[i, near], kind="stable")[:k]]
                if len(first) < len(ids):
                    near = np.array([first[g] + rows[i, first[g] : ends[g]].argmax() for g in near], np.int64)
                out_v.append(near)
                out_q.append(np.full(len(near), at + i))
        qi, vi = np.concatenate(out_q), np.concatenate(out_v)
        score = np.einsum("ij,ij->i", q[qi], v[vi])
        return pd.DataFrame({"query_id": own[qi], "vec_id": ids[vi], "score": score})

    return top


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    trees: int = 8,
    depth: int = 6,
    scan: float = 0.18,
    sample: int = 20_000,
    block: int = 4096,
    seed: int = 7,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """The ``k`` nearest rows found for every query row: query_id, rank, vec_id, score.

    ``scan`` is the share of all postings (rows x trees) a query may open;
    recall against exact search grows with it. Score: the inner product of the
    original vectors in double precision; ties go to the smaller id. A query is
    never its own neighbour. Vectors that are null, zero, of another length
    than most or hold null or non-finite components take no part. Rows that
    repeat an id and its vector count once; an id with several vectors keeps
    its best score. Null ids take no part. Empty tables give no rows.

    Scale: trees are fitted on at most ``sample`` rows. A leaf of more than
    ``block`` members, or with more queries than that, is cut into blocks by
    hash, each pair of blocks one task, so identical vectors fill no task.
    """
    spark = vectors.sparkSession

    def clean(df):
        df = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("embedding"))
        return df.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))

    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = clean(vectors)
    dims = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not dims:
        return empty
    dim = dims[0]["d"]
    rows = rows.where(F.size("embedding") == dim).dropDuplicates(["vec_id", "embedding"])
    fit = rows.orderBy(F.xxhash64("vec_id", F.lit(seed)), "vec_id").limit(sample).select("embedding").collect()
    forest = spark.sparkContext.broadcast(Forest(np.array([r[0] for r in fit]), trees, depth, seed))

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                b["leaves"] = list(forest.value.leaf_of(np.stack(b["embedding"].to_list())).astype(np.int32))
                yield b

    indexed = materialize(rows.mapInPandas(index, "vec_id long, embedding array<double>, leaves array<int>"), "ann-index")
    postings = indexed.select("vec_id", "embedding", F.posexplode("leaves").alias("tree", "leaf"))
    # one row a leaf of the forest: bounded by trees x leaves
    sizes = postings.groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("n")).collect()
    counts = np.zeros((trees, 2**depth), np.int64)
    for r in sizes:
        counts[r["tree"], r["leaf"]] = r["n"]
    budget = scan * counts.sum()
    # an id with several vectors has several postings in a tree: so many give k other ids for certain
    most = indexed.groupBy("vec_id").count().agg(F.max("count")).first()[0] or 1
    least = (k + 1) * most

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        f = forest.value
        for b in batches:
            for at in range(0, len(b), 256):
                part = b.iloc[at : at + 256]
                margins = f.margins(np.stack(part["query"].to_list()))
                yield pd.DataFrame(
                    {"query_id": part["query_id"], "query": part["query"],
                     "visits": [[{"tree": t, "leaf": x} for t, x in f.search(m, counts, budget, least)] for m in margins]}
                )

    asked = clean(queries).where(F.size("embedding") == dim).dropDuplicates(["vec_id", "embedding"])
    asked = asked.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    visits = asked.mapInPandas(visit, "query_id long, query array<double>, visits array<struct<tree:int,leaf:int>>")
    visits = materialize(visits, "ann-visits").select("query_id", "query", F.explode("visits").alias("x"))
    visits = visits.select("query_id", "query", "x.tree", "x.leaf")
    asks = visits.groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("q"))
    plan = spark.createDataFrame(sizes, "tree int, leaf int, n long").join(asks, ["tree", "leaf"])
    plan = plan.select("tree", "leaf", F.ceil(F.col("n") / block).alias("nv"), F.ceil(F.col("q") / block).alias("nq"))
    plan = F.broadcast(plan)  # bounded by trees x leaves
    members = postings.join(plan, ["tree", "leaf"]).select(
        "tree", "leaf", F.pmod(F.xxhash64("vec_id"), "nv").alias("vb"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("nq") - 1)).alias("qb"), "vec_id", "embedding",
    )
    asking = visits.join(plan, ["tree", "leaf"]).select(
        "tree", "leaf", F.pmod(F.xxhash64("query_id"), "nq").alias("qb"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("nv") - 1)).alias("vb"), "query_id", "query",
    )
    by = ["tree", "leaf", "vb", "qb"]
    found = asking.groupBy(*by).cogroup(members.groupBy(*by)).applyInPandas(_top_of_block(k), "query_id long, vec_id long, score double")
    # one shuffle for both steps: at most k rows a leaf that the query opened
    found = found.repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")

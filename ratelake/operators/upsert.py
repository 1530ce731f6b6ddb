"""Keyed conditional upsert (MERGE) as a DataFrame operator.

Semantics (the published MERGE): on key equality,

* matched and ``source.newer > target.newer``  -> update all columns
  (a NULL on either side compares false -> no update);
* not matched in target                       -> insert;
* target rows without a source row            -> kept; nothing is deleted.

Plan: one FULL OUTER equi-join on the key, each side packed into a struct so
that the whole row comes from one side (presence is tested on the struct,
never on a nullable data column). With ``prune_by`` (expressions of the key,
e.g. its month), only the target slices the source touches go through the
join; the rest is passed through as ``untouched``.

The action tag ``_change`` is one of ``inserted | updated | matched_noop |
untouched``. With ``compare`` columns, ``_values_changed`` tells an update
that changed a compared value from one that only carried a newer ingest time
(the same file re-sent under a new name), so both can be reported.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHANGE = "_change"
VALUES_CHANGED = "_values_changed"
ACTIONS = ("inserted", "updated", "matched_noop", "untouched")


class DuplicateSourceKeyError(ValueError):
    """The upsert source holds a key more than once (MERGE would fail)."""


def duplicate_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that appear more than once in ``source`` (with their count)."""
    return source.groupBy(*keys).count().filter(F.col("count") > 1)


def assert_unique_keys(source: DataFrame, keys: Sequence[str]) -> None:
    dup = duplicate_keys(source, keys).limit(1).collect()
    if dup:
        raise DuplicateSourceKeyError(f"upsert source has duplicate key {dup[0].asDict()}")


def _merge_core(
    target: DataFrame, source: DataFrame, keys: Sequence[str], newer_by: str, compare: Sequence[str] = ()
) -> DataFrame:
    cols = target.columns
    missing = [c for c in cols if c not in source.columns]
    if missing:
        raise ValueError(f"source lacks target columns {missing}")
    t = target.select(*keys, F.struct(*cols).alias("_t"))
    s = source.select(*keys, F.struct(*[F.col(c) for c in cols]).alias("_s"))
    j = t.join(s, on=list(keys), how="full_outer")
    t_here = F.col("_t").isNotNull()
    s_here = F.col("_s").isNotNull()
    newer = F.col(f"_s.{newer_by}") > F.col(f"_t.{newer_by}")
    action = (
        F.when(~t_here, F.lit("inserted"))
        .when(~s_here, F.lit("untouched"))
        .when(newer, F.lit("updated"))
        .otherwise(F.lit("matched_noop"))
    )
    take_source = ~t_here | (s_here & F.coalesce(newer, F.lit(False)))
    picked = F.when(take_source, F.col("_s")).otherwise(F.col("_t"))
    extra = []
    if compare:
        same = F.lit(True)
        for c in compare:
            same = same & F.col(f"_s.{c}").eqNullSafe(F.col(f"_t.{c}"))
        extra = [(t_here & s_here & F.coalesce(newer, F.lit(False)) & ~same).alias(VALUES_CHANGED)]
    tags = [CHANGE, VALUES_CHANGED] if compare else [CHANGE]
    return j.select(picked.alias("_r"), action.alias(CHANGE), *extra).select(
        *[F.col(f"_r.{c}").alias(c) for c in cols], *tags
    )


def merge_changes(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    newer_by: str,
    *,
    prune_by: Sequence[str] = (),
    compare: Sequence[str] = (),
) -> DataFrame:
    """All result rows of the upsert, each tagged with its ``_change``.

    ``prune_by`` holds SQL expressions over key columns alone (anything else
    doesn't resolve). Rows that match on the key then lie in one slice whatever
    their other columns hold, NULL included, so joining only the target's
    touched slices gives the same rows as the plain merge. Whether the slices
    are broadcast is left to Spark's own size estimate; the target is read for
    the touched and for the untouched part, so pass a stored one.
    """
    if not prune_by:
        return _merge_core(target, source, keys, newer_by, compare)
    names = [f"_slice_{i}" for i in range(len(prune_by))]
    slices = [F.expr(e).alias(n) for e, n in zip(prune_by, names)]
    touched = source.select(*keys).select(*slices).distinct()
    sliced = target.select(*keys).select(*slices)  # resolves over the key columns only
    assert sliced.columns == names
    same = None
    marked = target.select("*", *slices)
    for n in names:
        one = marked[n].eqNullSafe(touched[n])
        same = one if same is None else same & one
    hit = marked.join(touched, same, "left_semi").select(*target.columns)
    rest = marked.join(touched, same, "left_anti").select(*target.columns)
    merged = _merge_core(hit, source, keys, newer_by, compare)
    passed = rest.withColumn(CHANGE, F.lit("untouched"))
    if compare:
        passed = passed.withColumn(VALUES_CHANGED, F.lit(False))
    return merged.unionByName(passed)


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], newer_by: str, **kw) -> DataFrame:
    """The upserted table (no action columns)."""
    return merge_changes(target, source, keys, newer_by, **kw).drop(CHANGE, VALUES_CHANGED)


def change_counts(changes: DataFrame) -> DataFrame:
    """One row of counters from a tagged result (single aggregation)."""
    c = F.col(CHANGE)
    extra = []
    if VALUES_CHANGED in changes.columns:
        extra = [F.count_if(F.col(VALUES_CHANGED)).cast("bigint").alias("rows_changed")]
    return changes.agg(
        F.count_if(c == "inserted").cast("bigint").alias("rows_inserted"),
        F.count_if(c == "updated").cast("bigint").alias("rows_updated"),
        F.count_if(c == "matched_noop").cast("bigint").alias("rows_matched_noop"),
        F.count_if(c == "untouched").cast("bigint").alias("rows_untouched"),
        F.lit(0).cast("bigint").alias("rows_deleted"),
        F.count(F.lit(1)).cast("bigint").alias("rows_total"),
        *extra,
    )


def merge_into(source: DataFrame, table: str, keys: Sequence[str], newer_by: str) -> None:
    """The same upsert inside a catalog table that supports row-level operations.

    Spark raises ``UnsupportedOperationException`` for tables that don't (plain Parquet).
    """
    on = None
    for k in keys:
        one = F.col(f"{table}.{k}") == F.col(f"s.{k}")
        on = one if on is None else on & one
    newer = F.col(f"s.{newer_by}") > F.col(f"{table}.{newer_by}")
    source.alias("s").mergeInto(table, on).whenMatched(newer).updateAll().whenNotMatched().insertAll().merge()

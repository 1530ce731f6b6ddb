"""Trailing-window compounding (rolling 12-month accumulated rates).

``value = (exp(sum(ln f)) - 1) * 100`` over the trailing window, shown only
when the window is complete. Two completeness rules:

* ``gate="rows"``: the window holds ``months`` rows (published rule). A row
  whose factor is NULL still counts, so the value may compound fewer factors.
* ``gate="factors"``: the window holds ``months`` non-NULL, positive factors.

Two frames:

* ``frame="rows"``: the last ``months`` rows (published rule); a gap month
  makes the window span more than ``months`` calendar months.
* ``frame="months"``: the last ``months`` calendar months (RANGE frame over a
  month index), so a gap leaves the window incomplete instead.

Windows are partitioned by ``partition_by`` (the entity). With no entity the
input must be one row per period, declared with ``one_series=True``, as all of
it goes to one task; a multi-entity table must pass its entity columns.
``rolling_in_blocks`` deals a long series, or one very long among many, over
tasks: its numbered blocks are windows of their own, each with the rows before
it that its first windows reach back to.

``signed=True`` compounds factors of any sign (``functions.rates.product``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelake.functions.rates import product
from ratelake.session import materialize


def month_index(ym: str | Column) -> Column:
    """``yyyy-MM`` -> months since year 0 (for calendar RANGE frames)."""
    c = F.col(ym) if isinstance(ym, str) else ym
    return F.substring(c, 1, 4).cast("int") * F.lit(12) + F.substring(c, 6, 2).cast("int")


def rolling_compound(
    df: DataFrame,
    factors: Mapping[str, str],
    *,
    order_by: str = "year_month",
    partition_by: Sequence[str] = (),
    months: int = 12,
    gate: str = "rows",
    frame: str = "rows",
    count_col: str = "months_in_window",
    one_series: bool = False,
    signed: bool = False,
) -> DataFrame:
    """Add one rolling accumulated rate (percent, DOUBLE) per factor column."""
    if gate not in ("rows", "factors"):
        raise ValueError(f"gate must be 'rows' or 'factors', not {gate!r}")
    if frame not in ("rows", "months"):
        raise ValueError(f"frame must be 'rows' or 'months', not {frame!r}")

    if not partition_by and not one_series:
        raise ValueError("pass partition_by, or one_series=True for a table of one row per period")

    base = Window.partitionBy(*partition_by)
    if frame == "rows":
        w = base.orderBy(order_by).rowsBetween(-(months - 1), Window.currentRow)
    else:
        w = base.orderBy(month_index(order_by)).rangeBetween(-(months - 1), Window.currentRow)

    # One select: every window expression shares the spec, so Spark plans a
    # single Window operator over one sort.
    n_rows = F.count(F.col(order_by)).over(w)
    outs = [n_rows.cast("int").alias(count_col)]
    for name, fcol in factors.items():
        usable = F.col(fcol) if signed else F.log(F.col(fcol))
        complete = n_rows == months if gate == "rows" else F.count(usable).over(w) == months
        whole = product(fcol, lambda c: c.over(w)) if signed else F.exp(F.sum(usable).over(w))
        outs.append(F.when(complete, (whole - F.lit(1)) * F.lit(100)).alias(name))
    keep = [c for c in df.columns if c != count_col and c not in factors]
    return df.select(*keep, *outs)


def numbered(df: DataFrame, order_by: str, partition_by: Sequence[str] = (), number: str = "number") -> DataFrame:
    """``df`` with each entity's rows numbered from 1 by ``order_by``, without a window over an entity.

    The rows are sorted over range partitions and written; a row's number is its
    place in its partition and what earlier partitions hold of its entity. Only
    these counts (a row per entity and partition) are summed over a window.
    """
    by = list(partition_by)
    place = F.monotonically_increasing_id()
    ordered = df.repartitionByRange(*by, order_by).sortWithinPartitions(*by, order_by).withColumn("__id", place)
    rows = materialize(ordered, "numbered")
    rows = rows.withColumn("__part", F.shiftright("__id", 33)).withColumn("__at", F.col("__id").bitwiseAND(F.lit((1 << 33) - 1)))
    held = rows.groupBy(*by, "__part").agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__first"))
    earlier = Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    held = held.withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
    held = held.select(*[F.col(c).alias(f"__k_{i}") for i, c in enumerate(by)], F.col("__part").alias("__p"), "__first", "__before")
    same = F.col("__part") == F.col("__p")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"__k_{i}"))
    out = rows.join(held, same)
    return out.select(*df.columns, (F.col("__before") + F.col("__at") - F.col("__first") + 1).alias(number))


def rolling_in_blocks(
    df: DataFrame,
    factors: Mapping[str, str],
    *,
    order_by: str = "year_month",
    partition_by: Sequence[str] = (),
    months: int = 12,
    block_rows: int = 100_000,
    **options,
) -> DataFrame:
    """``rolling_compound`` with every entity's rows dealt over blocks of ``block_rows``.

    A block also gets the last ``months`` - 1 rows before it, so every window is
    whole in its block and gives the very same numbers; the rows lent are
    dropped afterwards. One row per entity and period, as everywhere here.
    """
    if block_rows < months:
        raise ValueError("a block must hold a window")
    cols, count_col = list(df.columns), options.get("count_col", "months_in_window")
    rows = numbered(df, order_by, partition_by, "__number").withColumn("__block", F.expr(f"(__number - 1) div {block_rows}"))
    lent = F.expr(f"(__number - 1) % {block_rows}") >= block_rows - (months - 1)
    rows = rows.withColumn("__to", F.explode(F.when(lent, F.array("__block", F.col("__block") + 1)).otherwise(F.array("__block"))))
    out = rolling_compound(
        rows, factors, order_by=order_by, partition_by=[*partition_by, "__to"], months=months, **options
    )
    keep = [c for c in cols if c != count_col and c not in factors]
    return out.where(F.col("__to") == F.col("__block")).select(*keep, count_col, *factors)

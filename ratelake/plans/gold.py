"""Gold: one row per month with compounded, real and rolling 12-month rates.

Plan (one-pass strategy): scan Silver once (series filter and the three
needed columns pushed to the scan) -> partial aggregate per month -> shuffle
of at most (#map tasks x #months) partial rows -> final aggregate -> Fisher
real factor -> trailing window over the months (bounded: one row per month)
-> DECIMAL(18,8) projection. The join strategy (the published definition:
two rollups FULL OUTER JOIN on the month) gives identical rows and is kept
for parity and tests.
"""

from __future__ import annotations

import bisect
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelake.functions.parsing import month_start
from ratelake.functions.rates import to_percent
from ratelake.operators.month_state import monthly_rates_of_state
from ratelake.operators.rolling import rolling_compound
from ratelake.operators.rollup import inflation_measures, policy_measures, rollup
from ratelake.settings import VALUE_TYPE, Settings


def monthly_rates(
    obs: DataFrame,
    policy_series: str,
    inflation_series: str,
    *,
    strategy: str = "onepass",
    by: Sequence[str] = (),
    value_type: str = VALUE_TYPE,
) -> DataFrame:
    """Per month: policy mean/days/factor, inflation rate/factor, real factor."""
    policy, inflation = policy_measures(policy_series), inflation_measures(inflation_series)
    if strategy == "onepass":
        m = rollup(obs, policy + inflation, by=by, value_type=value_type)
    elif strategy == "join":
        m = rollup(obs, policy, by=by, value_type=value_type).join(
            rollup(obs, inflation, by=by, value_type=value_type), on=[*by, "year_month"], how="full_outer"
        )
    else:
        raise ValueError(f"strategy must be 'onepass' or 'join', not {strategy!r}")
    return m.withColumn("month_start", month_start("year_month")).withColumn(
        # Fisher: real factor is the ratio of factors, not a difference of rates.
        "real_factor",
        F.col("policy_factor") / F.col("inflation_factor"),
    )


def build_gold(
    obs: DataFrame,
    settings: Settings,
    *,
    strategy: str | None = None,
    gate: str | None = None,
    frame: str | None = None,
    by: Sequence[str] = (),
    with_processed_at: bool = True,
) -> DataFrame:
    """The consolidated monthly table (12 columns; 11 without processed_at)."""
    vt = settings.value_type
    m = monthly_rates(
        obs,
        settings.policy_series,
        settings.inflation_series,
        strategy=strategy or settings.gold_strategy,
        by=by,
        value_type=vt,
    )
    return consolidated(m, settings, gate=gate, frame=frame, by=by, with_processed_at=with_processed_at)


def consolidated(
    m: DataFrame,
    settings: Settings,
    *,
    gate: str | None = None,
    frame: str | None = None,
    by: Sequence[str] = (),
    with_processed_at: bool = True,
) -> DataFrame:
    """The consolidated table of monthly rates, whichever way these were made."""
    vt = settings.value_type
    rolled = rolling_compound(
        m,
        {
            "policy_12m": "policy_factor",
            "inflation_12m": "inflation_factor",
            "real_12m": "real_factor",
        },
        partition_by=by,
        one_series=not by,  # the rollup leaves one row per month
        months=settings.rolling_months,
        gate=gate or settings.rolling_gate,
        frame=frame or settings.rolling_frame,
    )
    cols = [
        *by,
        "year_month",
        "month_start",
        "policy_mean_day",
        "policy_days",
        to_percent("policy_factor").cast(vt).alias("policy_month"),
        "inflation_month",
        to_percent("real_factor").cast(vt).alias("real_month"),
        F.col("policy_12m").cast(vt).alias("policy_12m"),
        F.col("inflation_12m").cast(vt).alias("inflation_12m"),
        F.col("real_12m").cast(vt).alias("real_12m"),
        "months_in_window",
    ]
    out = rolled.select(*cols)
    if with_processed_at:
        out = out.withColumn("processed_at", F.current_timestamp())
    return out


def refreshed_gold(stored: DataFrame, state: DataFrame, settings: Settings, first: str, last: str) -> DataFrame:
    """Gold after Silver changed in the months ``first`` .. ``last``, equal to a full rebuild.

    A month's row depends on its own rates and on those in its trailing window,
    so what changes is ``first`` up to ``rolling_months`` - 1 rows (or calendar
    months) after ``last``. These rows are computed anew, from as many months
    before as a window reaches back; all others are taken over as they stand.
    The months are a list bounded by the calendar.
    """
    months = sorted(r.year_month for r in state.where("year_month IS NOT NULL").select("year_month").distinct().collect())
    reach = settings.rolling_months - 1
    at = bisect.bisect_left(months, first)
    end = bisect.bisect_right(months, last) + reach  # rows; months without a row only make this reach farther
    if not months:
        return stored.limit(0)
    lower, upper = months[max(0, at - reach)], months[min(len(months), end) - 1]
    needed = state.where(F.col("year_month").between(lower, upper))
    rates = monthly_rates_of_state(needed, settings.policy_series, settings.inflation_series, settings.value_type)
    anew = consolidated(rates, settings).where(F.col("year_month").between(first, upper))
    kept = stored.where((F.col("year_month") < first) | (F.col("year_month") > upper))
    return kept.unionByName(anew.select(*stored.columns))

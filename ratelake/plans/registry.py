"""Registered queries over the benchmark tables, with DuckDB oracles.

Each query is ``(spark, sf_dir) -> DataFrame`` and reads the whole tables it
names. ``ORACLES`` holds, per query, ANSI SQL that DuckDB runs on the same
parquet tables (views named after the tables); columns are aliased to the same
names and cast to the same types on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake.operators.rolling import rolling_compound
from ratelake.operators.rollup import inflation_measures, policy_measures, rollup
from ratelake.functions.rates import to_percent
from ratelake.plans.gold import build_gold, monthly_rates
from ratelake.schemas import GOLD_TEXT, SILVER_TEXT
from ratelake.settings import INFLATION_SERIES, POLICY_SERIES
from ratelake.sources import standins

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

P = POLICY_SERIES.name
I = INFLATION_SERIES.name
DEC = "DECIMAL(18,8)"


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def _settings(spark: SparkSession):
    from ratelake.session import shared_root

    return standins.standin_settings(shared_root(spark))


# --------------------------------------------------------------------------
# Oracle building blocks (DuckDB dialect).
# --------------------------------------------------------------------------
def exact_mean_sql(col: str, decimals: int = 2, shift: int = 0) -> str:
    """Integer-only HALF_UP mean to 8 decimals (same definition as exact_mean)."""
    up = 8 - decimals - shift
    num = f"(SUM(CAST(CAST({col} AS DECIMAL(18,{decimals})) * {10 ** decimals} AS BIGINT)) * {10 ** up})"
    den = f"NULLIF(COUNT({col}), 0)"
    units = f"(CAST(sign({num}) AS BIGINT) * ((2 * abs({num}) + {den}) // (2 * {den})))"
    return f"CAST(CAST({units} AS DECIMAL(18,0)) * CAST(0.00000001 AS DECIMAL(18,8)) AS {DEC})"


OBS_CTE = f"""
policy_obs AS (
  SELECT CAST({POLICY_SERIES.series_id} AS INTEGER) AS series_id,
         '{P}' AS series_name, '{POLICY_SERIES.granularity}' AS granularity,
         CAST(l_shipdate AS DATE) AS ref_date,
         {exact_mean_sql('l_discount', 2)} AS value
  FROM lineitem GROUP BY CAST(l_shipdate AS DATE)
),
price_obs AS (
  SELECT CAST({INFLATION_SERIES.series_id} AS INTEGER) AS series_id,
         '{I}' AS series_name, '{INFLATION_SERIES.granularity}' AS granularity,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS ref_date,
         {exact_mean_sql('o_totalprice', 2, 6)} AS value
  FROM orders GROUP BY CAST(date_trunc('month', o_orderdate) AS DATE)
),
obs AS (
  SELECT series_id, series_name, granularity, ref_date,
         strftime(ref_date, '%Y-%m') AS year_month, value
  FROM (SELECT * FROM policy_obs UNION ALL SELECT * FROM price_obs) u
)"""

def _policy_m(src: str = "obs") -> str:
    return f"""
policy_m AS (
  SELECT year_month,
         CAST(AVG(value) AS {DEC}) AS policy_mean_day,
         CAST(COUNT(*) AS INTEGER) AS policy_days,
         EXP(SUM(LN(1 + value / 100))) AS policy_factor
  FROM {src} WHERE series_name = '{P}' GROUP BY year_month
)"""


def _price_m(src: str = "obs") -> str:
    return f"""
price_m AS (
  SELECT year_month,
         CAST(SUM(value) AS {DEC}) AS inflation_month,
         EXP(SUM(LN(1 + value / 100))) AS inflation_factor
  FROM {src} WHERE series_name = '{I}' GROUP BY year_month
)"""


POLICY_M_CTE = _policy_m()
PRICE_M_CTE = _price_m()

MONTHLY_CTE = f"""
monthly AS (
  SELECT year_month,
         CAST(year_month || '-01' AS DATE) AS month_start,
         policy_mean_day, policy_days, policy_factor,
         inflation_month, inflation_factor,
         policy_factor / inflation_factor AS real_factor
  FROM policy_m FULL OUTER JOIN price_m USING (year_month)
)"""


def _rolled_cte(gate: str = "rows", frame: str = "rows", months: int = 12) -> str:
    if frame == "rows":
        order = f"ORDER BY year_month ROWS BETWEEN {months - 1} PRECEDING AND CURRENT ROW"
    else:
        idx = "(CAST(substr(year_month, 1, 4) AS INTEGER) * 12 + CAST(substr(year_month, 6, 2) AS INTEGER))"
        order = f"ORDER BY {idx} RANGE BETWEEN {months - 1} PRECEDING AND CURRENT ROW"

    def acc(f: str) -> str:
        ok = f"COUNT(year_month) OVER w = {months}" if gate == "rows" else f"COUNT(LN({f})) OVER w = {months}"
        return f"CASE WHEN {ok} THEN (EXP(SUM(LN({f})) OVER w) - 1) * 100 END"

    return f"""
rolled AS (
  SELECT *,
         CAST(COUNT(year_month) OVER w AS INTEGER) AS months_in_window,
         {acc('policy_factor')} AS policy_12m_d,
         {acc('inflation_factor')} AS inflation_12m_d,
         {acc('real_factor')} AS real_12m_d
  FROM monthly
  WINDOW w AS ({order})
)"""


GOLD_SELECT = f"""
SELECT year_month, month_start, policy_mean_day, policy_days,
       CAST((policy_factor - 1) * 100 AS {DEC}) AS policy_month,
       inflation_month,
       CAST((real_factor - 1) * 100 AS {DEC}) AS real_month,
       CAST(policy_12m_d AS {DEC}) AS policy_12m,
       CAST(inflation_12m_d AS {DEC}) AS inflation_12m,
       CAST(real_12m_d AS {DEC}) AS real_12m,
       months_in_window
FROM rolled"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


def gold_oracle(gate: str = "rows", frame: str = "rows") -> str:
    return _with(OBS_CTE, POLICY_M_CTE, PRICE_M_CTE, MONTHLY_CTE, _rolled_cte(gate, frame)) + GOLD_SELECT


def _obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations written once: for layers that parse and filter them again."""
    return standins.observations(spark, sf_dir)


def _lazy_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations as a plan: a query on one series reads that series' table only."""
    return standins.observations(spark, sf_dir, materialize=False)


# --------------------------------------------------------------------------
# Rates algebra: monthly rollups (A1-A6, R1-R3)
# --------------------------------------------------------------------------
@register(
    "monthly_policy_rate",
    _with(OBS_CTE)
    + f"""
SELECT year_month,
       CAST(AVG(value) AS {DEC}) AS policy_mean_day,
       CAST(COUNT(*) AS INTEGER) AS policy_days,
       CAST((EXP(SUM(LN(1 + value / 100))) - 1) * 100 AS {DEC}) AS policy_month
FROM obs WHERE series_name = '{P}' GROUP BY year_month""",
)
def q_monthly_policy_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = rollup(_lazy_obs(spark, sf_dir), policy_measures(P))
    return m.select(
        "year_month",
        "policy_mean_day",
        "policy_days",
        to_percent("policy_factor").cast("decimal(18,8)").alias("policy_month"),
    )


@register(
    "monthly_inflation_rate",
    _with(OBS_CTE)
    + f"""
SELECT year_month,
       CAST(SUM(value) AS {DEC}) AS inflation_month,
       CAST((EXP(SUM(LN(1 + value / 100))) - 1) * 100 AS {DEC}) AS inflation_compound
FROM obs WHERE series_name = '{I}' GROUP BY year_month""",
)
def q_monthly_inflation_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = rollup(_lazy_obs(spark, sf_dir), inflation_measures(I))
    return m.select(
        "year_month",
        "inflation_month",
        to_percent("inflation_factor").cast("decimal(18,8)").alias("inflation_compound"),
    )


# --------------------------------------------------------------------------
# Full outer join + Fisher real rate (J1, R4, F4)
# --------------------------------------------------------------------------
REAL_SELECT = f"""
SELECT year_month, month_start, policy_mean_day, policy_days,
       CAST((policy_factor - 1) * 100 AS {DEC}) AS policy_month,
       inflation_month,
       CAST((real_factor - 1) * 100 AS {DEC}) AS real_month
FROM monthly"""


def _real_cols():
    return [
        "year_month",
        "month_start",
        "policy_mean_day",
        "policy_days",
        to_percent("policy_factor").cast("decimal(18,8)").alias("policy_month"),
        "inflation_month",
        to_percent("real_factor").cast("decimal(18,8)").alias("real_month"),
    ]


@register("real_rate_monthly", _with(OBS_CTE, POLICY_M_CTE, PRICE_M_CTE, MONTHLY_CTE) + REAL_SELECT)
def q_real_rate_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly_rates(_lazy_obs(spark, sf_dir), P, I, strategy="join").select(*_real_cols())


@register("real_rate_onepass", _with(OBS_CTE, POLICY_M_CTE, PRICE_M_CTE, MONTHLY_CTE) + REAL_SELECT)
def q_real_rate_onepass(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly_rates(_lazy_obs(spark, sf_dir), P, I, strategy="onepass").select(*_real_cols())


# --------------------------------------------------------------------------
# Rolling 12-month compounding (W2-W4, R5) and the consolidated table (R6)
# --------------------------------------------------------------------------
def _gold(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    return build_gold(_lazy_obs(spark, sf_dir), _settings(spark), with_processed_at=False, **kw)


@register("consolidated_monthly", gold_oracle())
def q_consolidated_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(spark, sf_dir, strategy="join")


@register("consolidated_monthly_onepass", gold_oracle())
def q_consolidated_monthly_onepass(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(spark, sf_dir, strategy="onepass")


def _rolling_only(df: DataFrame) -> DataFrame:
    return df.select("year_month", "months_in_window", "policy_12m", "inflation_12m", "real_12m")


ROLLING_SELECT = f"""
SELECT year_month, months_in_window,
       CAST(policy_12m_d AS {DEC}) AS policy_12m,
       CAST(inflation_12m_d AS {DEC}) AS inflation_12m,
       CAST(real_12m_d AS {DEC}) AS real_12m
FROM rolled"""


@register(
    "rolling12_rows_gate",
    _with(OBS_CTE, POLICY_M_CTE, PRICE_M_CTE, MONTHLY_CTE, _rolled_cte("rows")) + ROLLING_SELECT,
)
def q_rolling12_rows_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rolling_only(_gold(spark, sf_dir, gate="rows"))


@register(
    "rolling12_factor_gate",
    _with(OBS_CTE, POLICY_M_CTE, PRICE_M_CTE, MONTHLY_CTE, _rolled_cte("factors")) + ROLLING_SELECT,
)
def q_rolling12_factor_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rolling_only(_gold(spark, sf_dir, gate="factors"))


@register(
    "rolling12_calendar_months",
    _with(OBS_CTE, POLICY_M_CTE, PRICE_M_CTE, MONTHLY_CTE, _rolled_cte("rows", "months")) + ROLLING_SELECT,
)
def q_rolling12_calendar_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rolling_only(_gold(spark, sf_dir, gate="rows", frame="months"))


@register(
    "rolling12_by_segment",
    f"""
WITH seg AS (
  SELECT c.c_mktsegment AS segment,
         strftime(CAST(date_trunc('month', o.o_orderdate) AS DATE), '%Y-%m') AS year_month,
         {exact_mean_sql('o.o_totalprice', 2, 6)} AS value
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  GROUP BY 1, 2
), f AS (
  SELECT segment, year_month, value, 1 + value / 100 AS price_factor FROM seg
)
SELECT segment, year_month, value,
       CAST(COUNT(year_month) OVER w AS INTEGER) AS months_in_window,
       CAST(CASE WHEN COUNT(year_month) OVER w = 12
                 THEN (EXP(SUM(LN(price_factor)) OVER w) - 1) * 100 END AS {DEC}) AS price_12m
FROM f
WINDOW w AS (PARTITION BY segment ORDER BY year_month ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)""",
)
def q_rolling12_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rolling 12-month price rate per market segment.

    Orders are partially aggregated per (customer, month) *before* the join
    with the customer dimension: the join input shrinks to one row per
    customer-month and a customer holding a third of all orders becomes a
    handful of rows. The exact mean is finished after the join from the summed
    integer sums and counts.
    """
    from ratelake.functions.numeric import exact_mean_from, scaled_int

    orders = standins.table(spark, sf_dir, "orders")
    customer = standins.table(spark, sf_dir, "customer")
    per_customer = orders.groupBy(
        "o_custkey",
        F.date_format(F.trunc(F.to_date("o_orderdate"), "month"), "yyyy-MM").alias("year_month"),
    ).agg(F.sum(scaled_int("o_totalprice", 2)).alias("s"), F.count("o_totalprice").alias("n"))
    seg = (
        per_customer.join(customer, per_customer.o_custkey == customer.c_custkey)
        .groupBy(F.col("c_mktsegment").alias("segment"), "year_month")
        .agg(exact_mean_from("sum(s)", "sum(n)", decimals=2, shift=6).alias("value"))
        .withColumn("price_factor", F.lit(1) + F.col("value") / F.lit(100))
    )
    rolled = rolling_compound(seg, {"price_12m": "price_factor"}, partition_by=["segment"])
    return rolled.select(
        "segment",
        "year_month",
        "value",
        "months_in_window",
        F.col("price_12m").cast("decimal(18,8)").alias("price_12m"),
    )


# --------------------------------------------------------------------------
# Latest-wins dedup (W1) on real duplicates: lineitem (orderkey, linenumber)
# --------------------------------------------------------------------------
@register(
    "latest_wins_dedup",
    """
SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity
FROM (
  SELECT *, row_number() OVER (
           PARTITION BY l_orderkey, l_linenumber
           ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST) AS rn
  FROM lineitem) x
WHERE rn = 1""",
)
def q_latest_wins_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ratelake.operators.dedup import latest_wins

    li = standins.table(spark, sf_dir, "lineitem")
    order = [F.col(c).desc_nulls_last() for c in ("l_shipdate", "l_partkey", "l_suppkey")]
    return latest_wins(li, ["l_orderkey", "l_linenumber"], order).select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity"
    )


# --------------------------------------------------------------------------
# Tolerant typing (F1, F2, P3, P17) over raw text rendered from orders, with
# two realistic contract drifts: ISO dates for one priority class and a comma
# decimal separator for partially filled orders.
# --------------------------------------------------------------------------
RAW_ORDERS_CTE = f"""
raw AS (
  SELECT o_orderkey,
         CASE WHEN o_orderpriority = '5-LOW' THEN strftime(o_orderdate, '%Y-%m-%d')
              ELSE strftime(o_orderdate, '%d/%m/%Y') END AS date_raw,
         CASE WHEN o_orderstatus = 'P'
              THEN replace(CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) / 1000000 AS {DEC}) AS VARCHAR), '.', ',')
              ELSE CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) / 1000000 AS {DEC}) AS VARCHAR) END AS value_raw
  FROM orders
),
typed AS (
  SELECT o_orderkey, date_raw, value_raw,
         CASE WHEN regexp_full_match(date_raw, '[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}')
              THEN CAST(try_strptime(date_raw, '%d/%m/%Y') AS DATE) END AS ref_date,
         TRY_CAST(value_raw AS {DEC}) AS value
  FROM raw
)"""


def _raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = standins.table(spark, sf_dir, "orders")
    v = (F.col("o_totalprice").cast("decimal(18,2)") / F.lit(1000000)).cast("decimal(18,8)").cast("string")
    return o.select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") == "5-LOW", F.date_format("o_orderdate", "yyyy-MM-dd"))
        .otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
        .alias("date_raw"),
        F.when(F.col("o_orderstatus") == "P", F.replace(v, F.lit("."), F.lit(",")))
        .otherwise(v)
        .alias("value_raw"),
    )


@register(
    "tolerant_typing",
    _with(RAW_ORDERS_CTE)
    + """
SELECT o_orderkey, date_raw, value_raw, ref_date, value,
       (ref_date IS NULL OR value IS NULL) AS rejected
FROM typed""",
)
def q_tolerant_typing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ratelake.functions.parsing import parse_date, parse_decimal

    raw = _raw_orders(spark, sf_dir)
    return raw.select(
        "o_orderkey",
        "date_raw",
        "value_raw",
        parse_date("date_raw").alias("ref_date"),
        parse_decimal("value_raw").alias("value"),
    ).withColumn("rejected", F.col("ref_date").isNull() | F.col("value").isNull())


@register(
    "rejected_count",
    _with(RAW_ORDERS_CTE)
    + """
SELECT CAST(COUNT(*) AS BIGINT) AS raw_rows,
       CAST(COUNT(*) FILTER (WHERE ref_date IS NULL OR value IS NULL) AS BIGINT) AS rejected_rows,
       CAST(COUNT(*) FILTER (WHERE ref_date IS NULL) AS BIGINT) AS bad_date_rows,
       CAST(COUNT(*) FILTER (WHERE value IS NULL) AS BIGINT) AS bad_value_rows
FROM typed""",
)
def q_rejected_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ratelake.functions.parsing import parse_date, parse_decimal
    from ratelake.operators.conform import rejected_predicate

    raw = _raw_orders(spark, sf_dir)
    return raw.agg(
        F.count(F.lit(1)).cast("bigint").alias("raw_rows"),
        F.count_if(rejected_predicate()).cast("bigint").alias("rejected_rows"),
        F.count_if(parse_date("date_raw").isNull()).cast("bigint").alias("bad_date_rows"),
        F.count_if(parse_decimal("value_raw").isNull()).cast("bigint").alias("bad_value_rows"),
    )


# --------------------------------------------------------------------------
# File -> series mapping (P2) and unmapped files (D7) over event "files"
# --------------------------------------------------------------------------
# Fixed values for this query: a dimension over event feeds; 'error' feeds
# are deliberately absent so that they surface as unmapped.
EVENT_FEEDS = (
    ("click", 1, "clicks", "diaria"),
    ("view", 2, "views", "diaria"),
    ("signup", 3, "signups", "mensal"),
    ("purchase", 4, "purchases", "mensal"),
)


def _event_series():
    from ratelake.settings import SeriesSpec

    return [
        SeriesSpec(sid, name, gran, "count", rf"(^|/){feed}[^/]*\.json$", (0.0, 1e12))
        for feed, sid, name, gran in EVENT_FEEDS
    ]


def _event_case_sql(attr_index: int) -> str:
    whens = " ".join(
        f"WHEN regexp_matches(source_file, '(^|/){feed}[^/]*\\.json$') THEN {repr(vals[attr_index]) if isinstance(vals[attr_index], str) else vals[attr_index]}"
        for feed, *vals in EVENT_FEEDS
    )
    return f"CASE {whens} END"


EVENT_FILES_CTE = """
ev AS (
  SELECT event_id,
         'landing/' || event_type || '_' || strftime(ts, '%Y%m%d') || '.json' AS source_file
  FROM events
)"""


def _event_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = standins.table(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        F.concat(F.lit("landing/"), "event_type", F.lit("_"), F.date_format("ts", "yyyyMMdd"), F.lit(".json")).alias(
            "source_file"
        ),
    )


@register(
    "map_source_to_series",
    _with(EVENT_FILES_CTE)
    + f"""
SELECT event_id, source_file,
       CAST({_event_case_sql(0)} AS INTEGER) AS series_id,
       {_event_case_sql(1)} AS series_name,
       {_event_case_sql(2)} AS granularity
FROM ev""",
)
def q_map_source_to_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row gets its file's series; the patterns are tried once a file."""
    from ratelake.functions.series import join_series

    mapped = join_series(_event_files(spark, sf_dir), _event_series(), ("series_id", "name", "granularity"))
    return mapped.select("event_id", "source_file", "series_id", F.col("name").alias("series_name"), "granularity")


# Published names beside names that only look like them: another index or a number that is no period.
PERIOD_NAMES = {"view": "selic", "click": "ipca", "signup": "ipca-15", "purchase": "selic-432", "error": "ipca_"}


@register(
    "map_period_names",
    "WITH f AS (SELECT event_type, 'landing/' || CASE event_type "
    + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in PERIOD_NAMES.items())
    + " END || CASE WHEN event_type = 'error' THEN strftime(ts, '%Y-%m') ELSE '' END || '.json' AS source_file FROM events)"
    + f"""
SELECT source_file, CASE event_type WHEN 'view' THEN '{P}' WHEN 'click' THEN '{I}' WHEN 'error' THEN '{I}' END AS series_name,
       CAST(COUNT(*) AS BIGINT) AS rows
FROM f WHERE source_file IS NOT NULL GROUP BY 1, 2""",
)
def q_map_period_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A period in a file name is a year or month: ``ipca-15`` and ``selic-432`` are no part of a series."""
    from ratelake.functions.series import with_series
    from ratelake.settings import DEFAULT_SERIES

    ev, kind = standins.table(spark, sf_dir, "events"), F.col("event_type")
    name = F.coalesce(*[F.when(kind == k, F.lit(v)) for k, v in PERIOD_NAMES.items()])
    period = F.when(kind == "error", F.date_format("ts", "yyyy-MM")).otherwise(F.lit(""))
    files = ev.select(F.concat(F.lit("landing/"), name, period, F.lit(".json")).alias("source_file")).where("source_file IS NOT NULL")
    counted = files.groupBy("source_file").agg(F.count(F.lit(1)).alias("rows"))
    return with_series(counted, DEFAULT_SERIES, ("name",)).select("source_file", F.col("name").alias("series_name"), "rows")


@register(
    "unmapped_count",
    _with(EVENT_FILES_CTE)
    + f"""
SELECT CAST(COUNT(*) AS BIGINT) AS rows_total,
       CAST(COUNT(*) FILTER (WHERE ({_event_case_sql(0)}) IS NULL) AS BIGINT) AS unmapped_rows,
       CAST(COUNT(DISTINCT CASE WHEN ({_event_case_sql(0)}) IS NULL THEN source_file END) AS BIGINT) AS unmapped_files
FROM ev""",
)
def q_unmapped_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ratelake.functions.series import with_series

    per_file = _event_files(spark, sf_dir).groupBy("source_file").agg(F.count(F.lit(1)).alias("n"))
    lost, n = F.col("series_id").isNull(), F.col("n")
    return with_series(per_file, _event_series(), ("series_id",)).agg(
        F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias("rows_total"),
        F.coalesce(F.sum(F.when(lost, n)), F.lit(0)).cast("bigint").alias("unmapped_rows"),
        F.count(F.when(lost, F.col("source_file"))).cast("bigint").alias("unmapped_files"),
    )


# --------------------------------------------------------------------------
# Keyed upsert (S12, S13, J3, T4, S17, P16) over two event feeds, keyed by
# (user, day): the target holds the latest web event (view/click/signup) of
# each user-day, the source the latest app event (click/purchase/error).
# Shared clicks give equal timestamps (no-op), user-days seen by one feed
# only give inserts and untouched rows, so every MERGE branch occurs.
# --------------------------------------------------------------------------
UPSERT_KEYS = ("user_id", "event_day")
UPSERT_COLS = ("user_id", "event_day", "event_id", "event_type", "ts", "value")
TARGET_TYPES = ("view", "click", "signup")
SOURCE_TYPES = ("click", "purchase", "error")


def _latest_per_user_sql(types: tuple[str, ...]) -> str:
    inlist = ", ".join(f"'{t}'" for t in types)
    return f"""(
  SELECT user_id, event_day, event_id, event_type, ts, value FROM (
    SELECT *, CAST(ts AS DATE) AS event_day,
           row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE)
                              ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) AS rn
    FROM events WHERE event_type IN ({inlist})) x
  WHERE rn = 1)"""


def _merge_sql(target: str, source: str) -> str:
    pick = ", ".join(f"CASE WHEN take_s THEN s_{c} ELSE t_{c} END AS {c}" for c in UPSERT_COLS[2:])
    tcols = ", ".join(f"t.{c} AS t_{c}" for c in UPSERT_COLS)
    scols = ", ".join(f"s.{c} AS s_{c}" for c in UPSERT_COLS)
    return f"""(
  SELECT COALESCE(t_user_id, s_user_id) AS user_id, COALESCE(t_event_day, s_event_day) AS event_day, {pick},
         CASE WHEN t_p IS NULL THEN 'inserted' WHEN s_p IS NULL THEN 'untouched'
              WHEN s_ts > t_ts THEN 'updated' ELSE 'matched_noop' END AS _change
  FROM (
    SELECT *, (t_p IS NULL OR (s_p IS NOT NULL AND COALESCE(s_ts > t_ts, FALSE))) AS take_s
    FROM (SELECT 1 AS t_p, {tcols} FROM {target} t) tt
    FULL OUTER JOIN (SELECT 1 AS s_p, {scols} FROM {source} s) ss
      ON tt.t_user_id = ss.s_user_id AND tt.t_event_day = ss.s_event_day
  ) j)"""


UPSERT_CTE = f"""
tgt AS {_latest_per_user_sql(TARGET_TYPES)},
src AS {_latest_per_user_sql(SOURCE_TYPES)},
run1 AS {_merge_sql('tgt', 'src')},
run2 AS {_merge_sql('(SELECT user_id, event_day, event_id, event_type, ts, value FROM run1)', 'src')}"""

COUNTS_SELECT = """
SELECT CAST(COUNT(*) FILTER (WHERE _change = 'inserted') AS BIGINT) AS rows_inserted,
       CAST(COUNT(*) FILTER (WHERE _change = 'updated') AS BIGINT) AS rows_updated,
       CAST(COUNT(*) FILTER (WHERE _change = 'matched_noop') AS BIGINT) AS rows_matched_noop,
       CAST(COUNT(*) FILTER (WHERE _change = 'untouched') AS BIGINT) AS rows_untouched,
       CAST(0 AS BIGINT) AS rows_deleted,
       CAST(COUNT(*) AS BIGINT) AS rows_total
FROM {rel}"""


def _latest_per_user(ev: DataFrame, types: tuple[str, ...]) -> DataFrame:
    from ratelake.operators.dedup import latest_wins

    feed = ev.filter(F.col("event_type").isin(*types)).withColumn("event_day", F.to_date("ts")).select(*UPSERT_COLS)
    return latest_wins(feed, UPSERT_KEYS, [F.col("ts").desc_nulls_last(), F.col("event_id").desc_nulls_last()])


def _upsert_feeds(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    ev = standins.table(spark, sf_dir, "events")
    return _latest_per_user(ev, TARGET_TYPES), _latest_per_user(ev, SOURCE_TYPES)


def _upsert_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ratelake.operators.upsert import merge_changes

    return merge_changes(*_upsert_feeds(spark, sf_dir), UPSERT_KEYS, "ts")


def _upsert_runs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Both runs; the feeds and the first result are written once and read again."""
    from ratelake.operators.upsert import merge_changes
    from ratelake.session import materialize

    tgt, src = (materialize(df, "feed") for df in _upsert_feeds(spark, sf_dir))
    run1 = materialize(merge_changes(tgt, src, UPSERT_KEYS, "ts"), "first-run")
    return run1, merge_changes(run1.drop("_change"), src, UPSERT_KEYS, "ts")


@register("upsert_result", _with(UPSERT_CTE) + "\nSELECT * FROM run1")
def q_upsert_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upsert_once(spark, sf_dir)


@register("upsert_metrics", _with(UPSERT_CTE) + COUNTS_SELECT.format(rel="run1"))
def q_upsert_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ratelake.operators.upsert import change_counts

    return change_counts(_upsert_once(spark, sf_dir))


@register("upsert_twice_noop", _with(UPSERT_CTE) + COUNTS_SELECT.format(rel="run2"))
def q_upsert_twice_noop(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ratelake.operators.upsert import change_counts

    return change_counts(_upsert_runs(spark, sf_dir)[1])


@register(
    "upsert_history",
    _with(UPSERT_CTE)
    + """
SELECT CAST(v AS BIGINT) AS version, 'MERGE' AS operation,
       rows_inserted, rows_updated, rows_deleted
FROM (
  SELECT 1 AS v, COUNT(*) FILTER (WHERE _change = 'inserted') AS rows_inserted,
         COUNT(*) FILTER (WHERE _change = 'updated') AS rows_updated, CAST(0 AS BIGINT) AS rows_deleted FROM run1
  UNION ALL
  SELECT 2, COUNT(*) FILTER (WHERE _change = 'inserted'),
         COUNT(*) FILTER (WHERE _change = 'updated'), 0 FROM run2
) h""",
)
def q_upsert_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of a stored table into which the same source is merged twice, read through its metrics map."""
    from ratelake.session import materialize, scratch_dir
    from ratelake.sources.tables import StoredTable

    target, source = _upsert_feeds(spark, sf_dir)
    table = StoredTable(spark, scratch_dir(spark, "upserts"), target.schema)
    table.overwrite(target)
    source = materialize(source, "upsert-source")
    for _ in range(2):
        table.merge(source, UPSERT_KEYS, "ts")
    counts = [F.col("metrics")[c].cast("bigint").alias(c) for c in ("rows_inserted", "rows_updated", "rows_deleted")]
    return table.history().where("operation = 'MERGE'").select("version", "operation", *counts)


# --------------------------------------------------------------------------
# Stand-in layers: Bronze rows rendered from the observations, conformed to
# Silver, consolidated to Gold (no files; SQL re-derives every layer).
# --------------------------------------------------------------------------
def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standins.bronze_standin(_obs(spark, sf_dir))


def _silver(spark: SparkSession, sf_dir: str, bronze: DataFrame | None = None) -> DataFrame:
    """Silver written once as a table, as the layered run does."""
    from ratelake.operators.conform import conform
    from ratelake.session import materialize

    bronze = _bronze(spark, sf_dir) if bronze is None else bronze
    return materialize(conform(bronze, _settings(spark).series, with_processed_at=False), "silver")


def _standin_gold(spark: SparkSession, sf_dir: str, silver: DataFrame | None = None) -> DataFrame:
    silver = _silver(spark, sf_dir) if silver is None else silver
    return build_gold(silver, _settings(spark), with_processed_at=False)


def _standin_layers(spark: SparkSession, sf_dir: str):
    """Settings, Bronze rendered from the observations, Silver, Gold."""
    bronze = _bronze(spark, sf_dir)
    silver = _silver(spark, sf_dir, bronze)
    return _settings(spark), bronze, silver, _standin_gold(spark, sf_dir, silver)


def _case_sql(series, attr: str, col: str = "source_file") -> str:
    parts = []
    for sp in series:
        v = getattr(sp, attr)
        lit = f"'{v}'" if isinstance(v, str) else str(v)
        parts.append(f"WHEN regexp_matches({col}, '{sp.file_pattern}') THEN {lit}")
    return "CASE " + " ".join(parts) + " END"


_SS = standins.STANDIN_SERIES
LAYERS_CTE = f"""
bronze AS (
  SELECT strftime(ref_date, '%d/%m/%Y') AS date_raw,
         CAST(value AS VARCHAR) AS value_raw,
         'landing/feed=' || series_name || '_' || CAST(year(ref_date) AS VARCHAR) || '/part-00000.json' AS source_file,
         make_timestamp(year(ref_date) + 1, 1, 1, 0, 0, 0) AS file_modified_at,
         make_timestamp(year(ref_date) + 1, 1, 1, 1, 0, 0) AS ingested_at
  FROM obs
),
typed AS (
  SELECT CAST({_case_sql(_SS, 'series_id')} AS INTEGER) AS series_id,
         {_case_sql(_SS, 'name')} AS series_name,
         {_case_sql(_SS, 'granularity')} AS granularity,
         CASE WHEN regexp_full_match(date_raw, '[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}')
              THEN CAST(try_strptime(date_raw, '%d/%m/%Y') AS DATE) END AS ref_date,
         TRY_CAST(value_raw AS {DEC}) AS value,
         source_file, file_modified_at, ingested_at, date_raw, value_raw
  FROM bronze
),
silver AS (
  SELECT series_id, series_name, granularity, ref_date, strftime(ref_date, '%Y-%m') AS year_month,
         value, source_file, ingested_at
  FROM (SELECT *, row_number() OVER (
          PARTITION BY series_id, ref_date
          ORDER BY ingested_at DESC NULLS LAST, file_modified_at DESC NULLS LAST,
                   source_file DESC NULLS LAST, value DESC NULLS LAST) AS rn
        FROM typed
        WHERE series_id IS NOT NULL AND ref_date IS NOT NULL AND value IS NOT NULL) x
  WHERE rn = 1
),
{_policy_m('silver')},
{_price_m('silver')},
{MONTHLY_CTE},
{_rolled_cte()},
gold AS ({GOLD_SELECT})"""

STANDIN_FIRST, STANDIN_LAST, STANDIN_LAST_DATE = "1995-01-01", "2001-11", "2001-11-30"
STANDIN_MONTHS = 83

BRONZE_METRICS_SQL = f"""
SELECT CAST(COUNT(*) AS BIGINT) AS bronze_rows,
       CAST(COUNT(*) FILTER (WHERE source_file IS NULL OR ingested_at IS NULL) AS BIGINT) AS missing_provenance,
       CAST(COUNT(DISTINCT source_file) AS BIGINT) AS distinct_files,
       CAST(COUNT(DISTINCT {_case_sql(_SS, 'name')}) AS BIGINT) AS distinct_series,
       CAST(COUNT(*) FILTER (WHERE date_raw IS NULL AND value_raw IS NULL) AS BIGINT) AS empty_rows,
       CAST(COUNT(DISTINCT source_file) AS BIGINT) AS landing_files
FROM bronze"""

_DOMAIN_SQL = " OR ".join(
    f"(series_name = '{sp.name}' AND (value < {sp.domain[0]} OR value > {sp.domain[1]}))" for sp in _SS
)
SILVER_METRICS_SQL = f"""
SELECT CAST(COUNT(*) AS BIGINT) AS silver_rows,
       CAST((SELECT COUNT(*) FROM (SELECT DISTINCT series_id, ref_date FROM silver) d) AS BIGINT) AS distinct_keys,
       CAST(COUNT(*) FILTER (WHERE {_DOMAIN_SQL}) AS BIGINT) AS out_of_domain,
       CAST(COUNT(*) FILTER (WHERE ref_date < DATE '{STANDIN_FIRST}' OR ref_date > DATE '{STANDIN_LAST_DATE}') AS BIGINT) AS out_of_window,
       CAST(COUNT(DISTINCT year_month) FILTER (WHERE series_name = '{I}') AS BIGINT) AS inflation_months,
       CAST(COUNT(*) FILTER (WHERE series_name = '{I}' AND day(ref_date) <> 1) AS BIGINT) AS inflation_not_day1,
       CAST((SELECT COUNT(*) FROM (SELECT year_month FROM silver WHERE series_name = '{P}'
                                   GROUP BY year_month HAVING COUNT(*) < 15) t) AS BIGINT) AS thin_policy_months,
       CAST(COUNT(*) FILTER (WHERE value <= -100) AS BIGINT) AS nonpositive_factors,
       CAST(COUNT(*) FILTER (WHERE series_id IS NULL OR series_name IS NULL OR granularity IS NULL
                               OR ref_date IS NULL OR year_month IS NULL OR value IS NULL) AS BIGINT) AS null_required,
       CAST((SELECT COUNT(*) FROM typed WHERE ref_date IS NULL OR value IS NULL) AS BIGINT) AS rejected_rows,
       CAST((SELECT COUNT(*) FROM typed WHERE series_id IS NULL) AS BIGINT) AS unmapped_rows
FROM silver"""

GOLD_METRICS_SQL = """
SELECT CAST(COUNT(*) AS BIGINT) AS gold_rows,
       CAST(COUNT(DISTINCT year_month) AS BIGINT) AS distinct_months,
       CAST(COUNT(*) FILTER (WHERE policy_mean_day IS NULL OR policy_month IS NULL
                               OR inflation_month IS NULL OR real_month IS NULL) AS BIGINT) AS missing_metrics,
       CAST(COUNT(real_12m) AS BIGINT) AS filled_rolling,
       CAST(COUNT(*) FILTER (WHERE ABS((1 + real_month / 100) * (1 + inflation_month / 100)
                                       - (1 + policy_month / 100)) > 0.000001) AS BIGINT) AS fisher_violations,
       CAST(COUNT(*) FILTER (WHERE policy_days < 15) AS BIGINT) AS thin_policy_months
FROM gold"""


@register("bronze_metrics", _with(OBS_CTE, LAYERS_CTE) + BRONZE_METRICS_SQL)
def q_bronze_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze's numbers beside the number of files that were landed for it."""
    from ratelake.plans.metrics import bronze_metrics
    from ratelake.sources.landing import count_files, read_landing

    st, _ = _fresh_run(spark, sf_dir, "bronze-metrics")
    bronze = read_landing(spark, st.landing, st.file_glob, multi_line=st.multi_line)
    return bronze_metrics(bronze, st, count_files(spark, st.landing, st.file_glob).scalar())


@register("silver_metrics", _with(OBS_CTE, LAYERS_CTE) + SILVER_METRICS_SQL)
def q_silver_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ratelake.plans.metrics import silver_metrics

    bronze = _bronze(spark, sf_dir)
    return silver_metrics(_silver(spark, sf_dir, bronze), _settings(spark), bronze)


@register("gold_metrics", _with(OBS_CTE, LAYERS_CTE) + GOLD_METRICS_SQL)
def q_gold_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ratelake.plans.metrics import gold_metrics

    return gold_metrics(_standin_gold(spark, sf_dir), _settings(spark))


# The rules as plain SQL, written out apart from the rules in ``checks``:
# (layer, name, operator, target, SQL of the number, description).
_ROWS, _NULLS, _RANGE, _PERIODS = "rows in the table", "rows with a NULL in one of the columns", "values outside the range", "different periods present"
_EXTRA, _THIN, _HOLDS, _OUTSIDE = "rows beyond one per key", "periods with fewer rows than that", "rows where this holds", "measured outside the table"
BRONZE_RULES_SQL = [
    ("rows", ">=", 1, "SELECT COUNT(*) FROM bronze", _ROWS),
    ("not_null(source_file, ingested_at)", "=", 0, "SELECT COUNT(*) FROM bronze WHERE source_file IS NULL OR ingested_at IS NULL", _NULLS),
    ("series_present", "=", 2, f"SELECT COUNT(DISTINCT {_case_sql(_SS, 'name')}) FROM bronze", "series with a row"),
    ("never(no raw field)", "=", 0, "SELECT COUNT(*) FROM bronze WHERE date_raw IS NULL AND value_raw IS NULL", _HOLDS),
]
LANDING_RULES_SQL = [
    ("landing_files", ">=", 1, "SELECT COUNT(DISTINCT series_name || CAST(year(ref_date) AS VARCHAR)) FROM obs", _OUTSIDE),
    ("landing_files_without_rows", "=", 0, "SELECT 0", _OUTSIDE),
    ("landing_files_changed", "=", 0, "SELECT 0", _OUTSIDE),
]
SILVER_RULES_SQL = [
    ("unique(series_id, ref_date)", "=", 0, "SELECT COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT series_id, ref_date FROM silver) d) FROM silver", _EXTRA),
    ("not_null(series_id, series_name, granularity, ref_date, year_month, value)", "=", 0,
     "SELECT COUNT(*) FROM silver WHERE series_id IS NULL OR series_name IS NULL OR granularity IS NULL OR ref_date IS NULL OR year_month IS NULL OR value IS NULL", _NULLS),
    (f"in_range({P} value in 0.0 .. 1.0)", "=", 0, f"SELECT COUNT(*) FROM silver WHERE series_name = '{P}' AND (value < 0 OR value > 1)", _RANGE),
    (f"in_range({I} value in -5.0 .. 10.0)", "=", 0, f"SELECT COUNT(*) FROM silver WHERE series_name = '{I}' AND (value < -5 OR value > 10)", _RANGE),
    ("in_range(ref_date in 1995-01-01 .. 2001-11-30)", "=", 0, "SELECT COUNT(*) FROM silver WHERE ref_date < DATE '1995-01-01' OR ref_date > DATE '2001-11-30'", _RANGE),
    (f"periods({I})", "=", 83, f"SELECT COUNT(DISTINCT year_month) FROM silver WHERE series_name = '{I}'", _PERIODS),
    (f"never({I} not on day 1)", "=", 0, f"SELECT COUNT(*) FROM silver WHERE series_name = '{I}' AND day(ref_date) <> 1", _HOLDS),
    (f"dense({P}, 15 per year_month)", "=", 0, f"SELECT COUNT(*) FROM (SELECT year_month FROM silver WHERE series_name = '{P}' GROUP BY 1 HAVING COUNT(*) < 15) t", _THIN),
    ("never(rate at or below -100 %)", "=", 0, "SELECT COUNT(*) FROM silver WHERE value <= -100", _HOLDS),
    ("rejected_rows", "=", 0, "SELECT COUNT(*) FROM typed WHERE ref_date IS NULL OR value IS NULL", _OUTSIDE),
    ("unmapped_rows", "=", 0, "SELECT COUNT(*) FROM typed WHERE series_id IS NULL", _OUTSIDE),
]
GOLD_RULES_SQL = [
    ("unique(year_month)", "=", 0, "SELECT COUNT(*) - COUNT(DISTINCT year_month) FROM gold", _EXTRA),
    ("rows", "=", 83, "SELECT COUNT(*) FROM gold", _ROWS),
    ("not_null(policy_mean_day, policy_month, inflation_month, real_month)", "=", 0,
     "SELECT COUNT(*) FROM gold WHERE policy_mean_day IS NULL OR policy_month IS NULL OR inflation_month IS NULL OR real_month IS NULL", _NULLS),
    ("rolling_complete", "=", 72, "SELECT COUNT(real_12m) FROM gold", "months with a full window"),
    ("never(real x inflation differs from policy)", "=", 0,
     "SELECT COUNT(*) FROM gold WHERE ABS((1 + real_month / 100) * (1 + inflation_month / 100) - (1 + policy_month / 100)) > 0.000001", _HOLDS),
    ("never(fewer than 15 policy days)", "=", 0, "SELECT COUNT(*) FROM gold WHERE policy_days < 15", _HOLDS),
]


def _rules_sql(bronze_rules) -> str:
    parts = []
    for layer, rules in (("bronze", bronze_rules), ("silver", SILVER_RULES_SQL), ("gold", GOLD_RULES_SQL)):
        for name, op, target, number, text in rules:
            parts.append(
                f"SELECT '{layer}' AS layer, '{name}' AS name, n {op} {target} AS passed, '{op} {target}' AS expected, "
                f"CAST(n AS VARCHAR) AS observed, '{text}' AS description FROM ({number}) q(n)"
            )
    return _with(OBS_CTE, LAYERS_CTE) + "\n" + "\nUNION ALL\n".join(parts)


QUALITY_REPORT_SQL = _rules_sql(BRONZE_RULES_SQL)
RUN_REPORT_SQL = _rules_sql(LANDING_RULES_SQL + BRONZE_RULES_SQL)


def _quality_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules on the rendered layers, as a run checks them: over the counts per file
    and the month state. Those on landed files are left to the physical runs."""
    from ratelake.operators.month_state import month_state
    from ratelake.plans.checks import gold_results, ledger_results, state_results
    from ratelake.streaming.ledger import file_counts

    st, bronze, silver, gold = _standin_layers(spark, sf_dir)
    ledger = file_counts(bronze, st)
    return (
        ledger_results(ledger, st, None)
        .unionByName(state_results(month_state(silver, st.series), st, ledger))
        .unionByName(gold_results(gold, st))
    )


@register("quality_report_all", QUALITY_REPORT_SQL)
def q_quality_report_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _quality_results(spark, sf_dir)


@register(
    "check_report",
    "SELECT layer, name, CASE WHEN passed THEN 'PASSED' ELSE 'FAILED' END AS status, expected, observed, description "
    f"FROM ({QUALITY_REPORT_SQL}) r",
)
def q_check_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ratelake.plans.reports import check_report

    return check_report(_quality_results(spark, sf_dir))


# --------------------------------------------------------------------------
# Evidence reports (E1-E11) on the stand-in layers
# --------------------------------------------------------------------------
@register(
    "bronze_profile",
    _with(OBS_CTE, LAYERS_CTE)
    + """
SELECT source_file, CAST(COUNT(*) AS BIGINT) AS rows, MIN(date_raw) AS first_date_raw,
       MAX(date_raw) AS last_date_raw, CAST(MAX(ingested_at) AS VARCHAR) AS last_ingested_at
FROM bronze GROUP BY source_file""",
)
def q_bronze_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ratelake.plans.reports import bronze_profile

    bronze = _bronze(spark, sf_dir)
    return bronze_profile(bronze).withColumn("last_ingested_at", F.col("last_ingested_at").cast("string"))


@register(
    "bronze_sample",
    _with(OBS_CTE, LAYERS_CTE)
    + """
SELECT date_raw, value_raw, source_file, CAST(file_modified_at AS VARCHAR) AS file_modified_at,
       CAST(ingested_at AS VARCHAR) AS ingested_at
FROM bronze ORDER BY bronze.source_file, bronze.date_raw, bronze.value_raw LIMIT 10""",
)
def q_bronze_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ratelake.plans.reports import bronze_sample

    bronze = _bronze(spark, sf_dir)
    return bronze_sample(bronze).withColumn("ingested_at", F.col("ingested_at").cast("string")).withColumn(
        "file_modified_at", F.col("file_modified_at").cast("string")
    )


@register(
    "silver_profile",
    _with(OBS_CTE, LAYERS_CTE)
    + """
SELECT series_name, CAST(COUNT(*) AS BIGINT) AS rows, CAST(COUNT(DISTINCT ref_date) AS BIGINT) AS distinct_dates,
       MIN(ref_date) AS first_date, MAX(ref_date) AS last_date
FROM silver GROUP BY series_name""",
)
def q_silver_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ratelake.plans.reports import silver_profile

    silver = _silver(spark, sf_dir)
    return silver_profile(silver)


@register(
    "first_inflation_observations",
    _with(OBS_CTE, LAYERS_CTE)
    + f"""
SELECT series_id, series_name, granularity, ref_date, year_month, value, source_file,
       CAST(ingested_at AS VARCHAR) AS ingested_at
FROM silver WHERE series_name = '{I}' ORDER BY ref_date LIMIT 10""",
)
def q_first_inflation_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ratelake.plans.reports import first_observations

    silver = _silver(spark, sf_dir)
    return first_observations(silver, I).withColumn("ingested_at", F.col("ingested_at").cast("string"))


@register(
    "december_view",
    _with(OBS_CTE, LAYERS_CTE)
    + """
SELECT year_month,
       CAST(ROUND(inflation_12m, 2) AS DECIMAL(18,2)) AS inflation_12m,
       CAST(ROUND(policy_12m, 2) AS DECIMAL(18,2)) AS policy_12m,
       CAST(ROUND(real_12m, 2) AS DECIMAL(18,2)) AS real_12m
FROM gold WHERE year_month LIKE '%-12' ORDER BY year_month""",
)
def q_december_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ratelake.plans.reports import december_view

    gold = _standin_gold(spark, sf_dir)
    return december_view(gold)


@register(
    "monthly_view",
    _with(OBS_CTE, LAYERS_CTE)
    + """
SELECT year_month,
       CAST(ROUND(policy_mean_day, 6) AS DECIMAL(18,6)) AS policy_mean_day, policy_days,
       CAST(ROUND(policy_month, 4) AS DECIMAL(18,4)) AS policy_month,
       CAST(ROUND(inflation_month, 4) AS DECIMAL(18,4)) AS inflation_month,
       CAST(ROUND(real_month, 4) AS DECIMAL(18,4)) AS real_month,
       CAST(ROUND(policy_12m, 2) AS DECIMAL(18,2)) AS policy_12m,
       CAST(ROUND(inflation_12m, 2) AS DECIMAL(18,2)) AS inflation_12m,
       CAST(ROUND(real_12m, 2) AS DECIMAL(18,2)) AS real_12m
FROM gold ORDER BY year_month""",
)
def q_monthly_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ratelake.plans.reports import monthly_view

    gold = _standin_gold(spark, sf_dir)
    return monthly_view(gold)


@register(
    "layer_volumes",
    _with(OBS_CTE, LAYERS_CTE)
    + """
SELECT 'bronze' AS layer, CAST(COUNT(*) AS BIGINT) AS rows, CAST(COUNT(DISTINCT source_file) AS BIGINT) AS files FROM bronze
UNION ALL
SELECT 'silver', CAST(COUNT(*) AS BIGINT), CAST(COUNT(DISTINCT source_file) AS BIGINT) FROM silver
UNION ALL
SELECT 'gold', CAST(COUNT(*) AS BIGINT), CAST(NULL AS BIGINT) FROM gold""",
)
def q_layer_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ratelake.plans.reports import layer_volumes

    _, bronze, silver, gold = _standin_layers(spark, sf_dir)
    return layer_volumes(bronze, silver, gold)


@register(
    "ingest_batches",
    _with(OBS_CTE, LAYERS_CTE)
    + """
SELECT source_file, CAST(COUNT(*) AS BIGINT) AS rows, CAST(COUNT(DISTINCT ingested_at) AS BIGINT) AS ingest_batches
FROM bronze GROUP BY source_file""",
)
def q_ingest_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ratelake.plans.reports import ingest_batches

    bronze = _bronze(spark, sf_dir)
    return ingest_batches(bronze)


@register(
    "grain_report",
    _with(OBS_CTE, LAYERS_CTE)
    + """
SELECT 'silver' AS table_name, CAST(COUNT(*) AS BIGINT) AS rows,
       CAST((SELECT COUNT(*) FROM (SELECT DISTINCT series_id, ref_date FROM silver) d) AS BIGINT) AS distinct_keys
FROM silver
UNION ALL
SELECT 'gold', CAST(COUNT(*) AS BIGINT), CAST(COUNT(DISTINCT year_month) AS BIGINT) FROM gold""",
)
def q_grain_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ratelake.plans.reports import grain_report

    _, _, silver, gold = _standin_layers(spark, sf_dir)
    return grain_report(silver, gold)


YEARLY_REF_CTE = f"""
yearly_ref AS (
  SELECT strftime(ref_date, '%Y') || '-12' AS year_month,
         CAST(ROUND((EXP(SUM(LN(1 + value / 100))) - 1) * 100, 2) AS DECIMAL(18,2)) AS reference
  FROM price_obs GROUP BY strftime(ref_date, '%Y') HAVING COUNT(*) = 12
)"""


@register(
    "external_validation",
    _with(OBS_CTE, LAYERS_CTE, YEARLY_REF_CTE)
    + """
SELECT g.year_month,
       CAST(ROUND(g.inflation_12m, 2) AS DECIMAL(18,2)) AS inflation_12m,
       r.reference,
       CAST(ROUND(g.inflation_12m, 2) - r.reference AS DECIMAL(18,2)) AS difference,
       CAST(ROUND(g.policy_12m, 2) AS DECIMAL(18,2)) AS policy_12m,
       CAST(ROUND(g.real_12m, 2) AS DECIMAL(18,2)) AS real_12m
FROM gold g JOIN yearly_ref r ON r.year_month = g.year_month
ORDER BY g.year_month""",
)
def q_external_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold Decembers vs an independent yearly figure: the calendar-year
    product of the monthly price factors, computed straight from orders."""
    from ratelake.functions.rates import compound_rate
    from ratelake.plans.reports import external_validation

    gold = _standin_gold(spark, sf_dir)
    price = standins.price_observations(standins.table(spark, sf_dir, "orders"))
    yearly = (
        price.groupBy(F.year("ref_date").alias("y"))
        .agg(compound_rate("value").alias("r"), F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") == 12)
        .select(
            F.concat(F.col("y").cast("string"), F.lit("-12")).alias("year_month"),
            F.round("r", 2).cast("decimal(18,2)").alias("reference"),
        )
    )
    return external_validation(gold, yearly)


# --------------------------------------------------------------------------
# Physical runs: stand-in observations written as landing files to a fresh
# scratch folder under the shared root, then streamed, upserted and rebuilt.
# --------------------------------------------------------------------------
def _fresh_run(spark: SparkSession, sf_dir: str, label: str, obs_filter=None, **changes):
    from ratelake.session import scratch_dir

    root = scratch_dir(spark, label)
    st = standins.standin_settings(root, **changes)
    obs = _obs(spark, sf_dir)
    if obs_filter is not None:
        obs = obs.filter(obs_filter)
    standins.write_landing(obs, st.landing)
    return st, obs


FEED_SQL = "series_name || '_' || CAST(year(ref_date) AS VARCHAR)"


@register(
    "stream_ingest_counts",
    _with(OBS_CTE)
    + f"""
SELECT CAST((SELECT COUNT(*) FROM obs) AS BIGINT) AS rows_run1,
       CAST(0 AS BIGINT) AS rows_run2,
       CAST((SELECT COUNT(*) FROM obs) AS BIGINT) AS bronze_total,
       CAST((SELECT COUNT(DISTINCT {FEED_SQL}) FROM obs) AS BIGINT) AS landing_files""",
)
def q_stream_ingest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingest twice with availableNow: the rerun must read nothing."""
    from ratelake.streaming.ingest import ingest

    st, _ = _fresh_run(spark, sf_dir, "ingest")
    m1 = ingest(spark, st)
    m2 = ingest(spark, st)
    row = [(m1["rows_ingested"], m2["rows_ingested"], m2["rows_after"], m2["landing_files"])]
    return spark.createDataFrame(row, "rows_run1 bigint, rows_run2 bigint, bronze_total bigint, landing_files bigint")


@register("layered_run", RUN_REPORT_SQL)
def q_layered_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing -> Bronze (stream) -> Silver (upsert) -> Gold (rebuild), every
    gate evaluated; returns the check report of all layers."""
    from ratelake.plans.runner import run

    st, _ = _fresh_run(spark, sf_dir, "run")
    return run(spark, st, stop_on_failure=False).to_frame(spark)


@register("backfill_run", RUN_REPORT_SQL)
def q_backfill_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run over 1995-1998 first, then land the later years and backfill the
    wider window: the final report equals a single run over everything."""
    from ratelake.plans.runner import backfill, run

    st, obs = _fresh_run(
        spark, sf_dir, "backfill", F.year("ref_date") <= 1998, first_month="1995-01", last_month="1998-12"
    )
    run(spark, st, stop_on_failure=False)
    standins.write_landing(_obs(spark, sf_dir).filter(F.year("ref_date") > 1998), st.landing)
    return backfill(spark, st, "1995-01", "2001-11", stop_on_failure=False).to_frame(spark)


@register(
    "rerun_noop",
    _with(OBS_CTE)
    + """
SELECT CAST(0 AS BIGINT) AS rows_ingested, CAST(0 AS BIGINT) AS rows_inserted, CAST(0 AS BIGINT) AS rows_updated,
       CAST((SELECT COUNT(*) FROM obs) AS BIGINT) AS silver_rows,
       CAST((SELECT COUNT(DISTINCT year_month) FROM obs) AS BIGINT) AS gold_rows""",
)
def q_rerun_noop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The idempotence experiment: the second run ingests and changes nothing."""
    from ratelake.plans.runner import run

    st, _ = _fresh_run(spark, sf_dir, "rerun")
    run(spark, st, stop_on_failure=False)
    m = run(spark, st, stop_on_failure=False).metrics
    row = [
        (
            m["bronze"]["rows_ingested"],
            m["silver"]["rows_inserted"],
            m["silver"]["rows_updated"],
            m["silver"]["rows_total"],
            m["gold"]["rows"],
        )
    ]
    return spark.createDataFrame(
        row, "rows_ingested bigint, rows_inserted bigint, rows_updated bigint, silver_rows bigint, gold_rows bigint"
    )


@register(
    "landing_manifest",
    _with(OBS_CTE)
    + f"""
SELECT {FEED_SQL} AS feed, series_name, series_id, granularity,
       CAST(COUNT(*) AS BIGINT) AS rows, MIN(ref_date) AS first_date, MAX(ref_date) AS last_date,
       sha256(string_agg('{{"data":"' || strftime(ref_date, '%d/%m/%Y') || '","valor":"' || CAST(value AS VARCHAR) || '"}}' || chr(10), '' ORDER BY ref_date)) AS sha256
FROM obs GROUP BY {FEED_SQL}, series_name, series_id, granularity""",
)
def q_landing_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of the landed files; the digests are those of the files' whole content."""
    from ratelake.sources.landing import manifest

    st, _ = _fresh_run(spark, sf_dir, "manifest")
    m = manifest(spark, st.landing, st.series, st.file_glob, multi_line=st.multi_line)
    return m.select(
        F.regexp_extract("source_file", "feed=([^/]+)/", 1).alias("feed"),
        "series_name",
        "series_id",
        "granularity",
        "rows",
        "first_date",
        "last_date",
        "sha256",
    )


# One awkward file each: name, content, and what the contract says of it.
CONTRACT_FILES = [
    ("empty.json", "[]", 0, True, True, False, True, "empty list"),
    ("page.json", "<html>no</html>", 1, False, False, True, False, "not valid JSON"),
    ("object.json", '{"data": "01/01/2000", "valor": "1"}', 1, False, True, True, True, "not a list"),
    ("field.json", '[{"data": "01/01/2000"}]', 1, True, True, True, False, "records lack data/valor"),
    ("newline.json", "\n" * 400 + "\t " * 300 + '[{"data": "01/01/2000", "valor": "1"}]', 1, True, True, True, True, None),
    ("with space + pct%41.json", '[{"data": "01/01/2000", "valor": "1"}]', 1, True, True, True, True, None),
]
_FLAG = {True: "TRUE", False: "FALSE"}


@register(
    "payload_contract",
    _with(OBS_CTE)
    + f"""
SELECT {FEED_SQL} AS file, CAST(COUNT(*) AS BIGINT) AS records, TRUE AS is_list, TRUE AS valid_json,
       TRUE AS non_empty, TRUE AS fields_present, TRUE AS passed, CAST(NULL AS VARCHAR) AS failure
FROM obs GROUP BY {FEED_SQL}"""
    + "".join(
        f"\nUNION ALL SELECT '{name}', {n}, {_FLAG[lst]}, {_FLAG[js]}, {_FLAG[some]}, {_FLAG[both]}, {_FLAG[why is None]}, "
        + ("NULL" if why is None else f"'{why}'")
        for name, _, n, lst, js, some, both, why in CONTRACT_FILES
    ),
)
def q_payload_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract over one JSON array per feed and a file of every failing kind."""
    from ratelake.session import scratch_dir
    from ratelake.sources.landing import payload_contract

    root = scratch_dir(spark, "contract")
    obs = _obs(spark, sf_dir)
    record = F.struct(F.date_format("ref_date", "dd/MM/yyyy").alias("data"), F.col("value").cast("string").alias("valor"))
    arrays = obs.groupBy(standins.feed_name(obs).alias("feed")).agg(F.to_json(F.sort_array(F.collect_list(record))).alias("value"))
    arrays.repartition("feed").write.partitionBy("feed").text(root)
    for name, content, *_ in CONTRACT_FILES:
        standins.put_file(spark, f"{root}/{name}", content)
    found = payload_contract(spark, root, "*")
    feed = F.regexp_extract("source_file", "feed=([^/]+)/", 1)
    name = F.element_at(F.split("source_file", "/"), -1)
    return found.select(F.when(feed != "", feed).otherwise(name).alias("file"), *found.columns[1:])


@register(
    "key_uniqueness",
    """
SELECT CAST(COUNT(*) AS BIGINT) AS rows,
       CAST((SELECT COUNT(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) d) AS BIGINT) AS distinct_keys,
       CAST((SELECT COUNT(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem
                                  WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL) d) AS BIGINT)
         AS distinct_complete_keys,
       CAST(COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) d) AS BIGINT)
         AS duplicate_rows
FROM lineitem""",
)
def q_key_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared vs actual grain of lineitem's (orderkey, linenumber) key."""
    from ratelake.plans.reports import key_grain

    return key_grain(standins.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


SILVER_ROWS_SQL = (
    _with(OBS_CTE, LAYERS_CTE)
    + "\nSELECT series_id, series_name, granularity, ref_date, year_month, value FROM silver"
)
SILVER_ROW_COLS = ("series_id", "series_name", "granularity", "ref_date", "year_month", "value")


@register("layered_silver_rows", SILVER_ROWS_SQL)
def q_layered_silver_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver as stored by the physical run (stream -> conform -> upsert)."""
    from ratelake.plans.runner import run, silver_table

    st, _ = _fresh_run(spark, sf_dir, "silver-rows", silver_mode="batch")
    run(spark, st, stop_on_failure=False)
    return silver_table(spark, st).read().select(*SILVER_ROW_COLS)


@register("incremental_silver_rows", SILVER_ROWS_SQL)
def q_incremental_silver_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver built by the streaming mode: Bronze read as a stream, each
    micro-batch conformed and upserted in foreachBatch (replay-safe)."""
    from ratelake.streaming.ingest import incremental_silver, ingest, silver_table

    st, _ = _fresh_run(spark, sf_dir, "silver-stream", silver_mode="incremental", max_files_per_trigger=4)
    ingest(spark, st)
    got = incremental_silver(spark, st)
    if got["batches"] < 2:
        raise RuntimeError("the bound on files per trigger was not applied")
    return silver_table(spark, st).read().select(*SILVER_ROW_COLS)


@register("upsert_result_pruned", _with(UPSERT_CTE) + "\nSELECT * FROM run1")
def q_upsert_result_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same upsert, joining only the target rows of the days the source
    names (the day is a key column). The feeds are written first, so events is
    scanned once per feed."""
    from ratelake.operators.upsert import merge_changes
    from ratelake.session import materialize

    tgt, src = (materialize(df, "feed") for df in _upsert_feeds(spark, sf_dir))
    return merge_changes(tgt, src, UPSERT_KEYS, "ts", prune_by=["event_day"])


@register(
    "silver_history_two_runs",
    _with(OBS_CTE)
    + """
SELECT CAST(0 AS BIGINT) AS version, 'MERGE' AS operation,
       CAST((SELECT COUNT(*) FROM obs) AS BIGINT) AS rows_inserted,
       CAST(0 AS BIGINT) AS rows_updated, CAST(0 AS BIGINT) AS rows_deleted
UNION ALL
SELECT CAST(1 AS BIGINT), 'MERGE', CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT)""",
)
def q_silver_history_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of the Silver table after two runs over the same landing files
    (the idempotence evidence), read through the metrics map."""
    from ratelake.plans.runner import run, silver_table

    st, _ = _fresh_run(spark, sf_dir, "history", silver_mode="batch")
    run(spark, st, stop_on_failure=False)
    run(spark, st, stop_on_failure=False)
    return silver_table(spark, st).history().selectExpr(
        "version",
        "operation",
        "CAST(metrics['rows_inserted'] AS BIGINT) AS rows_inserted",
        "CAST(metrics['rows_updated'] AS BIGINT) AS rows_updated",
        "CAST(metrics['rows_deleted'] AS BIGINT) AS rows_deleted",
    )


# --------------------------------------------------------------------------
# Landing folder: late files, names, globs, contract
# --------------------------------------------------------------------------
@register(
    "late_file_ingest",
    _with(OBS_CTE)
    + f"""
SELECT CAST((SELECT COUNT(*) FROM obs WHERE series_name = '{P}') AS BIGINT) AS rows_run1,
       CAST((SELECT COUNT(*) FROM obs WHERE series_name = '{I}') AS BIGINT) AS rows_run2,
       CAST(0 AS BIGINT) AS files_without_rows""",
)
def q_late_file_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second series lands after the first was ingested, with file times
    30 days older: all of its rows must come in."""
    from ratelake.sources.landing import missing_files
    from ratelake.streaming.ingest import ingest, read_bronze

    st, obs = _fresh_run(spark, sf_dir, "late", F.col("series_name") == P)
    first = ingest(spark, st)["rows_ingested"]
    aside = f"{st.root}/aside"
    standins.write_landing(_obs(spark, sf_dir).where(F.col("series_name") == I), aside)
    standins.backdate(spark, aside, 30)
    standins.move_files(spark, aside, st.landing)
    second = ingest(spark, st)["rows_ingested"]
    lost = missing_files(spark, st.landing, read_bronze(spark, st.bronze_path), st.file_glob).count()
    return spark.createDataFrame([(first, second, lost)], "rows_run1 bigint, rows_run2 bigint, files_without_rows bigint")


# --------------------------------------------------------------------------
# Products of factors of any sign, and windows over one long series
# --------------------------------------------------------------------------
@register(
    "signed_product_rollup",
    """
SELECT l_orderkey, CAST(ROUND(product(l_quantity - 25)) AS BIGINT) AS whole, CAST(COUNT(*) AS INTEGER) AS rows
FROM lineitem GROUP BY l_orderkey""",
)
def q_signed_product_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates below, at and above -100 %: each order's lines compounded. A product that BIGINT can't hold is NULL."""
    from ratelake.functions.numeric import whole_number
    from ratelake.operators.rollup import Measure

    lines = _signed_lines(spark, sf_dir)
    m = rollup(lines, [Measure("whole", "line", "product"), Measure("rows", "line", "count")], period="l_orderkey", value_col="rate")
    return m.select("l_orderkey", whole_number(F.col("whole")).alias("whole"), "rows")


def _signed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = F.col("l_quantity").cast("double") - 25
    lines = standins.table(spark, sf_dir, "lineitem")
    return lines.select("l_orderkey", "l_linenumber", F.lit("line").alias("series_name"), f.alias("factor"), ((f - 1) * 100).alias("rate"))


@register(
    "signed_product_window",
    """
WITH f AS (SELECT o_custkey, o_orderkey, CAST(FLOOR(o_totalprice) AS BIGINT) % 51 - 25 AS factor FROM orders)
SELECT o_custkey, o_orderkey, CAST(COUNT(*) OVER w AS INTEGER) AS months_in_window,
       CASE WHEN COUNT(*) OVER w = 3 THEN CAST(ROUND((product(factor) OVER w - 1) * 100) AS BIGINT) END AS rate_3
FROM f WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
)
def q_signed_product_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trailing products of factors from -25 to 25, zero among them, over each customer's orders."""
    whole = F.floor("o_totalprice").cast("bigint")
    orders = standins.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", (whole % 51 - 25).alias("factor"))
    out = rolling_compound(orders, {"rate_3": "factor"}, order_by="o_orderkey", partition_by=["o_custkey"], months=3, signed=True)
    return out.select("o_custkey", "o_orderkey", "months_in_window", F.round("rate_3").cast("bigint").alias("rate_3"))


@register(
    "rolling12_one_long_series",
    """
SELECT o_orderkey, CAST(COUNT(*) OVER w AS INTEGER) AS months_in_window,
       CAST(ROUND(CASE WHEN COUNT(*) OVER w = 12 THEN (EXP(SUM(LN(1 + CAST(o_totalprice AS DOUBLE) / 100000000)) OVER w) - 1) * 100 END, 6) AS DECIMAL(18,6)) AS rate_12
FROM orders WINDOW w AS (ORDER BY o_orderkey ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)""",
)
def q_rolling12_one_long_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders as one series: its windows are dealt over blocks, no task gets the whole of it."""
    from ratelake.operators.rolling import rolling_in_blocks

    f = 1 + F.col("o_totalprice").cast("double") / 100_000_000
    orders = standins.table(spark, sf_dir, "orders").select("o_orderkey", f.alias("f"))
    out = rolling_in_blocks(orders, {"rate_12": "f"}, order_by="o_orderkey", block_rows=4096)
    return out.select("o_orderkey", "months_in_window", F.round("rate_12", 6).cast("decimal(18,6)").alias("rate_12"))


@register(
    "changed_file_ingest",
    _with(OBS_CTE, LAYERS_CTE)
    + """
SELECT series_id, series_name, granularity, ref_date, year_month, value,
       CAST((SELECT COUNT(DISTINCT series_name) FROM obs WHERE year(ref_date) = 1998) AS BIGINT) AS files_changed,
       CAST((SELECT COUNT(*) FROM obs WHERE year(ref_date) = 1998) AS BIGINT) AS rows_read_again,
       CAST(0 AS BIGINT) AS files_still_changed
FROM silver""",
)
def q_changed_file_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of one year are landed with other values, ingested, and then sent
    again, right, under their old names: Silver must hold the right values."""
    from ratelake.session import scratch_dir
    from ratelake.streaming.ingest import incremental_silver, ingest, silver_table
    from ratelake.streaming.ledger import changed_files, landed_files, read_ledger

    root = scratch_dir(spark, "changed")
    st = standins.standin_settings(root)
    obs = _obs(spark, sf_dir)
    wrong = F.when(F.year("ref_date") == 1998, F.col("value") + 1).otherwise(F.col("value"))
    standins.write_landing(obs.withColumn("value", wrong), st.landing)
    ingest(spark, st)
    incremental_silver(spark, st)
    aside = f"{root}/aside"
    standins.write_landing(obs.where(F.year("ref_date") == 1998), aside)
    standins.resend_files(spark, aside, st.landing)
    again = ingest(spark, st)
    incremental_silver(spark, st)
    left = changed_files(landed_files(spark, st), read_ledger(spark, st)).count()
    rows = silver_table(spark, st).read().select(*SILVER_ROW_COLS)
    counted = {"files_changed": again["files_changed"], "rows_read_again": again["rows_ingested"], "files_still_changed": left}
    return rows.select("*", *[F.lit(v).cast("bigint").alias(k) for k, v in counted.items()])


@register(
    "batch_replay",
    _with(OBS_CTE, LAYERS_CTE)
    + """
SELECT series_id, series_name, granularity, ref_date, year_month, value,
       CAST(1 AS BIGINT) AS writes_first, CAST(1 AS BIGINT) AS writes_replayed, CAST(2 AS BIGINT) AS writes_unrecorded,
       CAST(0 AS BIGINT) AS rows_changed_by_replays
FROM silver""",
)
def q_batch_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A micro-batch is run again, as after a crash before its commit: once with
    its write in the audit (skipped) and once without (merged again)."""
    from ratelake.session import remove_path
    from ratelake.streaming.ingest import incremental_silver, ingest, silver_table

    st, _ = _fresh_run(spark, sf_dir, "replay")
    ingest(spark, st)
    incremental_silver(spark, st)
    table, writes, changed = silver_table(spark, st), [], 0
    writes.append(table.audit().count())
    for lost in ("the commit", "the commit and the audit"):
        remove_path(spark, f"{st.checkpoints}/silver/commits/0")
        remove_path(spark, f"{st.checkpoints}/silver/commits/.0.crc")
        if lost != "the commit":
            table.audit().where("false").coalesce(1).write.mode("overwrite").parquet(table.audit_path)
        got = incremental_silver(spark, st)
        changed += got["rows_inserted"] + got["rows_updated"]
        writes.append(table.audit().count() + (lost != "the commit"))
    counted = dict(zip(("writes_first", "writes_replayed", "writes_unrecorded"), writes)) | {"rows_changed_by_replays": changed}
    rows = table.read().select(*SILVER_ROW_COLS)
    return rows.select("*", *[F.lit(v).cast("bigint").alias(k) for k, v in counted.items()])


GOLD_ROWS_SQL = gold_oracle()


@register("incremental_gold_rows", GOLD_ROWS_SQL)
def q_incremental_gold_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold as the runs leave it: the first years, then the later ones, then a
    late correction of one month in the middle. Each run recomputes the months
    it touches and those whose window holds them, and takes the others over."""
    from ratelake.plans.runner import gold_table, run

    wrong = F.when(F.date_format("ref_date", "yyyy-MM") == "1997-05", F.col("value") + 1).otherwise(F.col("value"))
    st, _ = _fresh_run(spark, sf_dir, "gold-steps", F.lit(False))
    obs = _obs(spark, sf_dir)
    early = obs.where(F.year("ref_date") <= 1999).withColumn("value", wrong.cast("decimal(18,8)"))
    standins.write_landing(early, st.landing)
    run(spark, st, stop_on_failure=False)
    standins.write_landing(obs.where(F.year("ref_date") > 1999), st.landing)
    run(spark, st, stop_on_failure=False)
    standins.write_landing(obs.where(F.date_format("ref_date", "yyyy-MM") == "1997-05"), f"{st.root}/aside")
    standins.move_files(spark, f"{st.root}/aside", st.landing)
    m = run(spark, st, stop_on_failure=False).metrics
    if not m["gold"]["committed"] or run(spark, st, stop_on_failure=False).metrics["gold"]["committed"]:
        raise RuntimeError("Gold must be written when Silver changed, and only then")
    return gold_table(spark, st).read().drop("processed_at")


@register(
    "month_state_recount",
    _with(OBS_CTE, LAYERS_CTE)
    + """
SELECT series_id, series_name, year_month, CAST(COUNT(*) AS BIGINT) AS rows, CAST(COUNT(DISTINCT ref_date) AS BIGINT) AS keys,
       CAST(SUM(value) AS DECIMAL(38,8)) AS value_sum, CAST(COUNT(*) FILTER (day(ref_date) <> 1) AS BIGINT) AS not_day_1
FROM silver GROUP BY series_id, series_name, year_month""",
)
def q_month_state_recount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The month state kept up by merges of two loads, of which the second corrects and adds."""
    from ratelake.streaming.ingest import incremental_silver, ingest, silver_table

    obs = _obs(spark, sf_dir)
    st, _ = _fresh_run(spark, sf_dir, "state", F.lit(False))
    wrong = F.when(F.year("ref_date") == 1996, F.col("value") * 2).otherwise(F.col("value"))
    standins.write_landing(obs.where(F.year("ref_date") <= 1998).withColumn("value", wrong.cast("decimal(18,8)")), st.landing)
    ingest(spark, st)
    incremental_silver(spark, st)
    later = obs.where((F.year("ref_date") == 1996) | (F.year("ref_date") > 1998))
    standins.write_landing(later, st.landing)
    ingest(spark, st)
    incremental_silver(spark, st)
    return silver_table(spark, st).state().select("series_id", "series_name", "year_month", "rows", "keys", "value_sum", "not_day_1")


@register(
    "landing_glob",
    _with(OBS_CTE) + f"\nSELECT {FEED_SQL} AS feed, CAST(COUNT(*) AS BIGINT) AS rows FROM obs GROUP BY {FEED_SQL}",
)
def q_landing_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of other names beside the landed ones are not read."""
    from ratelake.sources.landing import read_landing

    st, obs = _fresh_run(spark, sf_dir, "glob")
    obs.select(F.to_json(F.struct(F.col("year_month").alias("data"))).alias("value")).write.mode("append").text(f"{st.landing}/feed=notes_2000")
    rows = read_landing(spark, st.landing, st.file_glob, multi_line=False)
    return rows.groupBy(F.regexp_extract("source_file", "feed=([^/]+)/", 1).alias("feed")).agg(F.count(F.lit(1)).alias("rows"))


@register(
    "literal_series",
    _with(OBS_CTE, LAYERS_CTE)
    + f"""
SELECT s.series_name, s.unit, CAST(COUNT(v.value) AS BIGINT) AS rows
FROM (SELECT '{P}' AS series_name, '% a.d.' AS unit UNION ALL SELECT '{I}', '% a.m.' UNION ALL SELECT 'none', NULL) s
LEFT JOIN silver v ON v.series_name = s.series_name GROUP BY 1, 2""",
)
def q_literal_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A literal relation and a union of literal rows, joined with Silver in SQL."""
    _silver(spark, sf_dir).createOrReplaceTempView("literal_silver")
    return spark.sql(
        f"""SELECT s.series_name, s.unit, COUNT(v.value) AS rows
            FROM (SELECT * FROM VALUES ('{P}', '% a.d.'), ('{I}', '% a.m.') AS t(series_name, unit)
                  UNION ALL SELECT 'none', CAST(NULL AS STRING)) s
            LEFT JOIN literal_silver v ON v.series_name = s.series_name GROUP BY s.series_name, s.unit"""
    )


_TEXTS = "SELECT 'silver' AS table_name, CAST((SELECT COUNT(*) FROM obs) AS BIGINT) AS rows, '{}' AS text UNION ALL SELECT 'gold', CAST((SELECT COUNT(DISTINCT year_month) FROM obs) AS BIGINT), '{}'"


@register("named_tables", _with(OBS_CTE) + _TEXTS.format(SILVER_TEXT, GOLD_TEXT))
def q_named_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored tables by their catalog names, with their table comments."""
    import uuid

    from ratelake.plans.runner import run

    db = f"ratelake_{uuid.uuid4().hex[:8]}"
    st, _ = _fresh_run(spark, sf_dir, "named", database=db)
    run(spark, st, stop_on_failure=False)
    out = None
    for name in ("silver", "gold"):
        text = spark.sql(f"DESCRIBE TABLE EXTENDED {db}.{name}").where("col_name = 'Comment'").select(F.col("data_type").alias("text"))
        rows = spark.table(f"{db}.{name}").agg(F.count(F.lit(1)).alias("rows"))
        one = rows.select(F.lit(name).alias("table_name"), "rows", F.lit(text.first()[0]).alias("text"))
        out = one if out is None else out.unionByName(one)
    return out


@register(
    "view_scalars",
    _with(OBS_CTE, LAYERS_CTE) + "\nSELECT CAST((SELECT COUNT(*) FROM silver) AS BIGINT) AS silver_rows, (SELECT MAX(year_month) FROM gold) AS last_month",
)
def q_view_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scalar queries over the temp views of a finished run."""
    from ratelake.plans.runner import run
    from ratelake.plans.views import register_views, scalar

    st, _ = _fresh_run(spark, sf_dir, "views")
    run(spark, st, stop_on_failure=False)
    register_views(spark, st, prefix="scalars_")
    row = (scalar(spark, "SELECT COUNT(*) FROM scalars_silver"), scalar(spark, "SELECT MAX(year_month) FROM scalars_gold"))
    return spark.createDataFrame([row], "silver_rows bigint, last_month string")


@register("gate_outcome", f"SELECT layer, name, expected, observed FROM ({RUN_REPORT_SQL}) r WHERE NOT passed AND layer = 'silver'")
def q_gate_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules that stop a strict run: the first layer that breaks any."""
    from ratelake.operators.quality import RESULT_SCHEMA, DataQualityError
    from ratelake.plans.runner import run

    st, _ = _fresh_run(spark, sf_dir, "gate", silver_mode="batch", gate_mode="before_commit")
    broken = []
    try:
        run(spark, st)
    except DataQualityError as err:
        broken = err.broken
    return spark.createDataFrame(broken, RESULT_SCHEMA).select("layer", "name", "expected", "observed")

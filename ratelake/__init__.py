"""ratelake — a Spark-native engine for published rate series.

Raw JSON landing files are ingested incrementally (Structured Streaming),
typed tolerantly, de-duplicated by "latest ingest wins", upserted by business
key into a partitioned Parquet table, and consolidated into a monthly table of
compounded, Fisher-real and rolling 12-month rates. Declarative quality checks
gate every layer in one aggregation pass per table.

Every operator is a ``DataFrame -> DataFrame`` function over named columns, so
it runs unchanged on a laptop fixture or a cluster-sized table.
"""

from ratelake.settings import Settings, SeriesSpec, DEFAULT_SERIES


def __getattr__(name):
    # Lazy re-exports of the main entry points (keeps `import ratelake` light).
    lazy = {
        "run": ("ratelake.plans.runner", "run"),
        "backfill": ("ratelake.plans.runner", "backfill"),
        "build_gold": ("ratelake.plans.gold", "build_gold"),
        "conform": ("ratelake.operators.conform", "conform"),
        "latest_wins": ("ratelake.operators.dedup", "latest_wins"),
        "merge_changes": ("ratelake.operators.upsert", "merge_changes"),
        "rolling_compound": ("ratelake.operators.rolling", "rolling_compound"),
        "StoredTable": ("ratelake.sources.tables", "StoredTable"),
        "register_views": ("ratelake.plans.views", "register_views"),
    }
    if name in lazy:
        import importlib

        module, attr = lazy[name]
        return getattr(importlib.import_module(module), attr)
    raise AttributeError(name)


__all__ = [
    "Settings",
    "SeriesSpec",
    "DEFAULT_SERIES",
    "run",
    "backfill",
    "build_gold",
    "conform",
    "latest_wins",
    "merge_changes",
    "rolling_compound",
    "StoredTable",
    "register_views",
]
__version__ = "0.1.0"

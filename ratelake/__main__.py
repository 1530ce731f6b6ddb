"""Command line: ``python -m ratelake run|backfill|report --root PATH``.

Uses the session the platform provides (``SparkSession.builder.getOrCreate()``),
so ``spark-submit`` settings apply. Exit code 1 when a quality gate fails,
which fails the scheduled job the same way an exception in the layer would.
"""

from __future__ import annotations

import argparse
import json
import logging
import sys

from ratelake.operators.quality import DataQualityError
from ratelake.settings import Settings


def _settings(args) -> Settings:
    kw = {"root": args.root}
    if args.first_month:
        kw["first_month"] = args.first_month
    if args.last_month:
        kw["last_month"] = args.last_month
    if args.silver_mode:
        kw["silver_mode"] = args.silver_mode
    if args.gate_mode:
        kw["gate_mode"] = args.gate_mode
    if args.database:
        kw["database"] = args.database
    return Settings(**kw)


def main(argv: list[str] | None = None, spark=None) -> int:
    p = argparse.ArgumentParser(prog="ratelake")
    p.add_argument("command", choices=["run", "backfill", "report"])
    p.add_argument("--root", required=True, help="folder holding landing/, checkpoints/ and tables/")
    p.add_argument("--first-month")
    p.add_argument("--last-month")
    p.add_argument("--silver-mode", choices=["batch", "incremental"])
    p.add_argument("--gate-mode", choices=["after_commit", "before_commit"])
    p.add_argument("--database", help="catalog schema to name the tables in")
    args = p.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(name)s %(levelname)s: %(message)s [%(relativeCreated)d ms]")

    if spark is None:
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.appName("ratelake").getOrCreate()
    st = _settings(args)

    if args.command == "report":
        from ratelake.plans.views import evidence

        for name, df in evidence(spark, st).items():
            print(f"== {name}")
            df.show(100, truncate=False)
        return 0

    from ratelake.plans.runner import backfill, run

    try:
        if args.command == "run":
            report = run(spark, st)
        else:
            report = backfill(spark, st, st.first_month, st.last_month)
    except DataQualityError as err:
        print(f"quality gate failed: {err}", file=sys.stderr)
        return 1
    print(json.dumps(report.metrics, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())

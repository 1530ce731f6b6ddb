"""Stand-in rate series derived, by Spark, from the benchmark tables.

The benchmark tables carry no published rates, so two observation series
are derived from them; every query that uses them grows with the tables.

* policy (daily):  per ship day, the mean ``l_discount`` as DECIMAL(18,8);
  values lie in [0, 0.1] like a daily policy rate in percent.
* price (monthly): per order month (day 1), the mean ``o_totalprice`` (as
  DECIMAL(18,2)) divided by 1,000,000; values near 0.15 like a monthly
  inflation rate in percent.

Both means are exact fixed-point means rounded HALF_UP to 8 decimals
(``exact_mean``), so any engine reproduces them digit for digit.

They use the policy/inflation series metadata, so default settings apply.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import dataclasses

from ratelake.functions.numeric import exact_mean
from ratelake.functions.parsing import year_month
from ratelake.settings import DEFAULT_SERIES, INFLATION_SERIES, POLICY_SERIES, SeriesSpec, Settings

OBS_COLUMNS = ("series_id", "series_name", "granularity", "ref_date", "year_month", "value")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _tag(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    return df.select(
        F.lit(spec.series_id).cast("int").alias("series_id"),
        F.lit(spec.name).alias("series_name"),
        F.lit(spec.granularity).alias("granularity"),
        "ref_date",
        year_month("ref_date").alias("year_month"),
        "value",
    )


def policy_observations(lineitem: DataFrame, spec: SeriesSpec = POLICY_SERIES) -> DataFrame:
    daily = lineitem.groupBy(F.to_date("l_shipdate").alias("ref_date")).agg(
        exact_mean("l_discount", decimals=2).alias("value")
    )
    return _tag(daily, spec)


def price_observations(orders: DataFrame, spec: SeriesSpec = INFLATION_SERIES) -> DataFrame:
    monthly = orders.groupBy(F.trunc(F.to_date("o_orderdate"), "month").alias("ref_date")).agg(
        exact_mean("o_totalprice", decimals=2, shift=6).alias("value")
    )
    return _tag(monthly, spec)


def observations(spark: SparkSession, sf_dir: str, *, materialize: bool = True) -> DataFrame:
    """Long observation table: both stand-in series.

    The table has one row per series and day (bounded by the calendar, not
    by the size of the source tables), so it is written once as a table in
    the shared folder and read back. That cuts the lineage for the layers
    built on top, and stops the optimizer from pushing Silver's per-row
    parsing predicates below the daily rollup into the raw scan.
    """
    obs = policy_observations(table(spark, sf_dir, "lineitem")).unionByName(
        price_observations(table(spark, sf_dir, "orders"))
    )
    if not materialize:
        return obs
    from ratelake.session import materialize

    return materialize(obs, "observations")


def _folder_pattern(name: str) -> str:
    # Spark writers name files part-*; the series is in the folder name.
    return rf"[/=]{name}_[0-9]{{4}}/[^/]+\.json$"


# Stand-in landing layout: <landing>/feed=<series>_<year>/part-*.json
STANDIN_SERIES = tuple(dataclasses.replace(s, file_pattern=_folder_pattern(s.name)) for s in DEFAULT_SERIES)


def standin_settings(root: str, **changes) -> Settings:
    """Settings for the stand-ins: benchmark calendar (1995-01..2001-11),
    JSON-lines landing files in one folder per series-year."""
    base = Settings(
        root=root, series=STANDIN_SERIES, first_month="1995-01", last_month="2001-11", multi_line=False
    )
    return base.with_(**changes) if changes else base


def feed_name(obs: DataFrame):
    return F.concat(F.col("series_name"), F.lit("_"), F.year("ref_date").cast("string"))


def bronze_standin(obs: DataFrame, date_format: str = "dd/MM/yyyy") -> DataFrame:
    """Bronze-shaped rows for the observations, without physical files.

    One notional landing file per series-year, modified on the next New
    Year's Day and ingested an hour later (deterministic, so that reports
    over it have an SQL oracle).
    """
    modified = F.make_timestamp(
        F.year("ref_date") + 1, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)
    )
    return obs.select(
        F.date_format("ref_date", date_format).alias("date_raw"),
        F.col("value").cast("string").alias("value_raw"),
        F.concat(F.lit("landing/feed="), feed_name(obs), F.lit("/part-00000.json")).alias("source_file"),
        modified.alias("file_modified_at"),
        (modified + F.expr("INTERVAL 1 HOUR")).alias("ingested_at"),
    )


def write_landing(obs: DataFrame, landing: str, date_format: str = "dd/MM/yyyy") -> None:
    """Write the observations as landing files (JSON lines of data/valor text in
    order of date), one folder per series-year, partitioned by Spark. The rows
    are bounded by the calendar: one per series and day."""
    (
        obs.select(
            feed_name(obs).alias("feed"),
            F.date_format("ref_date", date_format).alias("data"),
            F.col("value").cast("string").alias("valor"),
            "ref_date",
        )
        .repartition("feed")
        .sortWithinPartitions("feed", "ref_date")
        .drop("ref_date")
        .write.mode("append")
        .partitionBy("feed")
        .json(landing)
    )


def _hadoop(spark: SparkSession, path: str):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hp = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, hp, hp.getFileSystem(conf)


def put_file(spark: SparkSession, path: str, text: str) -> None:
    """Write one small landing file under its exact name."""
    _, hp, fs = _hadoop(spark, path)
    out = fs.create(hp, True)
    out.write(bytearray(text.encode()))
    out.close()


def backdate(spark: SparkSession, folder: str, days: int) -> None:
    """Set the files under ``folder`` back in time, as a copy with kept times would."""
    jvm, hp, fs = _hadoop(spark, folder)
    found = fs.listFiles(hp, True)
    while found.hasNext():
        f = found.next()
        fs.setTimes(f.getPath(), f.getModificationTime() - days * 86_400_000, -1)


def move_files(spark: SparkSession, source: str, folder: str) -> None:
    """Move data files into a folder, keeping sub-folders and file times."""
    jvm, hp, fs = _hadoop(spark, source)
    base = fs.makeQualified(hp).toString().rstrip("/") + "/"
    found, names = fs.listFiles(hp, True), []
    while found.hasNext():
        names.append(found.next().getPath().toString())
    for name in (n for n in names if "/part-" in n):
        to = jvm.org.apache.hadoop.fs.Path(f"{folder}/{name.removeprefix(base)}")
        fs.mkdirs(to.getParent())
        fs.rename(jvm.org.apache.hadoop.fs.Path(name), to)


def resend_files(spark: SparkSession, source: str, folder: str) -> int:
    """Put data files in the place of landed ones, under the landed names; how many.

    ``source`` has one file in each of some of ``folder``'s sub-folders, as a
    publisher that sends a corrected file again under its old name.
    """
    jvm, hp, fs = _hadoop(spark, source)
    done = 0
    for sub in fs.listStatus(hp):
        name = sub.getPath().getName()
        if not sub.isDirectory():
            continue
        new = [f.getPath() for f in fs.listStatus(sub.getPath()) if f.getPath().getName().startswith("part-")]
        old = [f.getPath() for f in fs.listStatus(jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")) if f.getPath().getName().startswith("part-")]
        for a, b in zip(new, old, strict=True):
            fs.delete(b, False)
            fs.rename(a, b)
            done += 1
    return done

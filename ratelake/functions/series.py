"""File -> series mapping (the series id is not in the payload)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelake.settings import SeriesSpec


def series_attribute(path: str | Column, series: Sequence[SeriesSpec], attr: str) -> Column:
    """CASE over the series file patterns; an unmapped file gives NULL.

    A file that two patterns match is an error: its rows would overwrite
    observations of the wrong series. A short CASE stays inside whole-stage
    codegen and needs no join; the dimension has one entry per series.
    """
    if not series:
        return F.lit(None)
    path = F.col(path) if isinstance(path, str) else path
    hits = [path.rlike(spec.file_pattern) for spec in series]
    out = F
    if len(series) > 1:
        found = reduce(add, [h.cast("int") for h in hits])
        out = F.when(found > 1, F.raise_error(F.concat(F.lit("several series match the file "), path)))
    for hit, spec in zip(hits, series):
        out = out.when(hit, F.lit(getattr(spec, attr)))
    return out


def series_of(path: str | Column, series: Sequence[SeriesSpec]) -> Column:
    """Struct of all attributes of the series whose pattern the path matches; NULL for none.

    One filter over the patterns, whatever their number and however many
    attributes are wanted. A path that two patterns match is an error.
    """
    path = F.col(path) if isinstance(path, str) else path
    specs = [F.struct(F.lit(s.series_id).cast("int").alias("series_id"), *[F.lit(getattr(s, a)).alias(a) for a in ("name", "granularity", "unit", "file_pattern")]) for s in series]
    if not specs:
        return F.lit(None).cast("struct<series_id:int,name:string,granularity:string,unit:string>")
    hits = F.filter(F.array(*specs), lambda s: F.rlike(path, s["file_pattern"]))
    clash = F.raise_error(F.concat(F.lit("several series match the file "), path))
    return F.when(F.size(hits) > 1, clash).otherwise(F.get(hits, F.lit(0)))


def with_series(files: DataFrame, series: Sequence[SeriesSpec], attrs: Sequence[str], path: str = "source_file") -> DataFrame:
    """``files`` (one row per file, or few) with attributes of their series."""
    found = files.withColumn("__series", series_of(path, series))
    return found.select(*files.columns, *[F.col(f"__series.{a}").alias(a) for a in attrs])


def join_series(rows: DataFrame, series: Sequence[SeriesSpec], attrs: Sequence[str], path: str = "source_file") -> DataFrame:
    """Rows with attributes of their file's series, the patterns tried once a file.

    The different files are mapped apart and joined by name; they are few
    beside their rows, so Spark broadcasts them unless its own estimate says no.
    """
    files = with_series(rows.select(F.col(path).alias("__file")).where(F.col(path).isNotNull()).distinct(), series, attrs, "__file")
    return rows.join(files, rows[path] == files["__file"], "left").drop("__file")

"""Landing area: raw JSON files -> rows with provenance.

* fixed all-STRING schema (no inference: the raw text is preserved);
* ``multiLine`` for pretty-printed JSON arrays (one row per element), or
  JSON lines when ``multi_line=False``;
* ``pathGlobFilter`` (default ``*.json``); names starting with ``_`` or ``.``
  (e.g. ``_manifest.json``) are hidden from every Spark file source;
* provenance from the hidden ``_metadata`` column: decoded file path and
  modification time; ``ingested_at`` is the micro-batch time. Every view of a
  file uses this one path, so names with blanks or ``%`` join like any other.

File-level views: ``list_files`` and ``count_files`` (names and sizes only),
``manifest`` (bytes, sha256, parsed rows, first/last date; the digest needs the
whole content, so files are limited to 2 GB there) and ``payload_contract``
(valid JSON list, non-empty, fields present; reads lines, not whole files).
"""

from __future__ import annotations

import logging
import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake.functions.parsing import parse_date
from ratelake.functions.series import series_attribute
from ratelake.schemas import RAW_PAYLOAD
from ratelake.settings import RAW_DATE_FORMAT, SeriesSpec


LOGGER = logging.getLogger("ratelake.landing")


def file_path() -> Column:
    """Decoded path of a row's file (``_metadata.file_path`` is URL-encoded, plus signs are not)."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def _reader(reader, glob: str, multi_line: bool, recursive: bool):
    r = reader.format("json").schema(RAW_PAYLOAD).option("multiLine", str(multi_line).lower())
    r = r.option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    return r


def _with_provenance(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("data").alias("date_raw"),
        F.col("valor").alias("value_raw"),
        file_path().alias("source_file"),
        F.col("_metadata.file_modification_time").alias("file_modified_at"),
        F.current_timestamp().alias("ingested_at"),
    )


def read_landing(
    spark: SparkSession,
    path: str,
    glob: str = "*.json",
    *,
    multi_line: bool = True,
    recursive: bool = True,
) -> DataFrame:
    """Batch read of every landing file (Bronze-shaped rows)."""
    return _with_provenance(_reader(spark.read, glob, multi_line, recursive).load(path))


def read_files(spark: SparkSession, paths: Sequence[str], *, multi_line: bool = True) -> DataFrame:
    """Batch read of some landing files by their (decoded) paths."""
    # a path is a glob to the reader: its own special characters are escaped
    plain = [re.sub(r"([\\\[\]{}*?,])", r"\\\1", p) for p in paths]
    return _with_provenance(_reader(spark.read, "*", multi_line, False).load(plain))


def stream_landing(
    spark: SparkSession,
    path: str,
    glob: str = "*.json",
    *,
    multi_line: bool = True,
    recursive: bool = True,
    max_files_per_trigger: int | None = None,
    max_file_age: str = "36500d",
    archive: str | None = None,
) -> DataFrame:
    """Streaming read: each new file is read once per checkpoint.

    With ``archive`` files are moved there once a later batch or run has begun
    (Spark keeps their whole path below it), so the landing folder that every
    trigger lists holds new files only.

    ``max_file_age`` is explicit, as Spark's default of a week silently drops
    files with an older modification time than that before the newest one.
    """
    r = _reader(spark.readStream, glob, multi_line, recursive).option("maxFileAge", max_file_age)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if archive:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return _with_provenance(r.load(path))


def _files(spark: SparkSession, path: str, glob: str, recursive: bool = True) -> DataFrame:
    r = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    return r.load(path)


def list_files(spark: SparkSession, path: str, glob: str = "*.json", recursive: bool = True) -> DataFrame:
    """``source_file, file_modified_at, bytes`` per file (content column pruned).

    Spark's file sources leave out files of zero bytes: they hold no record.
    """
    return _files(spark, path, glob, recursive).select(
        file_path().alias("source_file"), F.col("modificationTime").alias("file_modified_at"), F.col("length").alias("bytes")
    )


def count_files(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """One row, one column: number of landing files."""
    return list_files(spark, path, glob).agg(F.count(F.lit(1)).cast("bigint").alias("landing_files"))


def is_missing(err: Exception) -> bool:
    return isinstance(err, AnalysisException) and err.getCondition() == "PATH_NOT_FOUND"


def files_in(spark: SparkSession, path: str, glob: str = "*.json") -> int:
    """Number of landing files. A folder that doesn't exist holds none (logged); other errors are raised."""
    try:
        return int(count_files(spark, path, glob).first()[0])
    except AnalysisException as err:
        if not is_missing(err):
            raise
        LOGGER.warning("landing folder %s doesn't exist: no files", path)
        return 0


def missing_files(spark: SparkSession, path: str, bronze: DataFrame, glob: str = "*.json") -> DataFrame:
    """Landed files of which Bronze has no row (late, lost or empty lists)."""
    landed = list_files(spark, path, glob)
    return landed.join(bronze.select("source_file").distinct(), "source_file", "left_anti")


def manifest(
    spark: SparkSession,
    path: str,
    series: Sequence[SeriesSpec],
    glob: str = "*.json",
    *,
    multi_line: bool = True,
    date_format: str = RAW_DATE_FORMAT,
) -> DataFrame:
    """Per landing file: series, bytes, sha256, rows, first and last date."""
    files = _files(spark, path, glob).select(
        file_path().alias("source_file"),
        F.col("length").alias("bytes"),
        F.sha2(F.col("content"), 256).alias("sha256"),
        F.col("modificationTime").alias("file_modified_at"),
    )
    rows = (
        read_landing(spark, path, glob, multi_line=multi_line)
        .withColumn("d", parse_date("date_raw", date_format))
        .groupBy("source_file")
        .agg(
            F.count(F.lit(1)).cast("bigint").alias("rows"),
            F.min("d").alias("first_date"),
            F.max("d").alias("last_date"),
        )
    )
    src = F.col("source_file")
    return files.join(rows, "source_file", "left").select(
        "source_file",
        series_attribute(src, series, "name").alias("series_name"),
        series_attribute(src, series, "series_id").cast("int").alias("series_id"),
        series_attribute(src, series, "granularity").alias("granularity"),
        series_attribute(src, series, "unit").alias("unit"),
        "bytes",
        "sha256",
        F.coalesce(F.col("rows"), F.lit(0)).cast("bigint").alias("rows"),
        "first_date",
        "last_date",
        "file_modified_at",
    )


def payload_contract(
    spark: SparkSession, path: str, glob: str = "*.json", *, multi_line: bool = True
) -> DataFrame:
    """Per file: is it a non-empty JSON list of records with both fields?

    A permissive read turns a non-JSON file into one all-NULL row, ``[]`` into
    zero rows and a missing field into NULL; a top-level object is accepted as
    one row, so "is a list" is tested on the first character that is not white
    space, wherever it stands. Lines are ordered by their file block and their
    place in it, so large files may be split.
    """
    lines = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true").text(path)
    first = F.substring(F.regexp_replace("value", r"^[\s\uFEFF]+", ""), 1, 1)
    order = F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    heads = lines.select(file_path().alias("source_file"), first.alias("c"), order.alias("o")).where("c <> ''")
    heads = heads.groupBy("source_file").agg(F.min_by("c", "o").alias("first_char"))
    files = list_files(spark, path, glob).select("source_file").join(heads, "source_file", "left")
    rows = (
        read_landing(spark, path, glob, multi_line=multi_line)
        .groupBy("source_file")
        .agg(
            F.count(F.lit(1)).cast("bigint").alias("records"),
            F.count_if(F.col("date_raw").isNull() & F.col("value_raw").isNull()).cast("bigint").alias("unparsed"),
            F.count_if(F.col("date_raw").isNull()).cast("bigint").alias("missing_date"),
            F.count_if(F.col("value_raw").isNull()).cast("bigint").alias("missing_value"),
        )
    )
    j = files.join(rows, "source_file", "left").fillna(0, ["records", "unparsed", "missing_date", "missing_value"])
    # A pretty-printed file must be one JSON array; a JSON-lines file holds
    # one record (or one array of records) per line.
    first_char = F.coalesce("first_char", F.lit(""))
    is_list = first_char == "[" if multi_line else first_char.isin("[", "{")
    non_empty = F.col("records") > 0
    valid_json = F.col("unparsed") == 0
    fields = (F.col("missing_date") == 0) & (F.col("missing_value") == 0)
    reason = (
        F.when(~valid_json, F.lit("not valid JSON"))
        .when(~is_list, F.lit("not a list"))
        .when(~non_empty, F.lit("empty list"))
        .when(~fields, F.lit("records lack data/valor"))
    )
    return j.select(
        "source_file",
        "records",
        is_list.alias("is_list"),
        valid_json.alias("valid_json"),
        non_empty.alias("non_empty"),
        fields.alias("fields_present"),
        (is_list & non_empty & valid_json & fields).alias("passed"),
        reason.alias("failure"),
    )

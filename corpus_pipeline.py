"""Corpus pipeline: quality, line dedup, near-dedup, decontamination, packing.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns the next stage's ``docs``. ``run`` applies them to ``documents``,
writing and rereading every stage's result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake.llm import decontam, line_dedup, near_dup, packing, quality
from ratelake.llm.common import crc_of_id, materialize, small, table
from ratelake.llm.queries import tokenizer_path


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the neighbours' vote doesn't accept; the classifier learns as in op9."""
    may_learn = crc_of_id("doc_id") % 4 != 2
    model = quality.fit(quality.labelled_sample(docs, table(spark, sf_dir, "labels"), may_learn))
    if model is None:  # nothing labelled: nothing is known against any document
        return docs
    return docs.where(quality.scorer(spark, model)(F.col("text")) >= quality.ACCEPT)


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop each source's boilerplate lines; all documents stay, n_chars follows the text."""
    out = line_dedup.drop_boilerplate(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def keep_one_of_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest document of every near-duplicate class.

    A document is known by its id and the hash of its text. Rows that share
    both are one document: they are reduced to one row apart from the rest. The
    documents to drop are broadcast if counted few, so the texts that stay are
    not shuffled for them.
    """
    own = F.struct(F.col("doc_id"), F.xxhash64("text").alias("h"))
    classes = materialize(near_dup.near_duplicates(docs.select(own.alias("doc_id"), "text")), "classes")
    key = F.col("doc_id").alias("__rl_id")
    dropped = materialize(classes.where(F.col("doc_id") != F.col("class_id")).select(key).distinct(), "dropped")
    repeated = classes.where(F.col("doc_id") == F.col("class_id")).groupBy(key).count().where("count > 1")
    repeated = materialize(repeated.select("__rl_id"), "repeated")
    kept = docs.withColumn("__rl_id", own).join(small(dropped), "__rl_id", "left_anti")
    if not repeated.isEmpty():
        once = kept.join(small(repeated), "__rl_id", "left_semi").dropDuplicates(["__rl_id"])
        kept = kept.join(small(repeated), "__rl_id", "left_anti").unionByName(once)
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a window of a benchmark item."""
    found = decontam.contamination(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    found = found.where("contaminated").select(F.col("doc_id").alias("__rl_id"), F.col("text_hash").alias("__rl_h")).distinct()
    found = small(materialize(found, "contaminated"))
    return docs.join(found, F.col("doc_id").eqNullSafe(F.col("__rl_id")) & (F.xxhash64("text") == F.col("__rl_h")), "left_anti")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As op7, with less memory a worker: executors whose heaps have grown over four stages leave less to Python."""
    return packing.pack_documents(docs, tokenizer_path(), cache_bytes=24_000_000, slice_bytes=1_000_000)


STAGES = [
    ("quality classifier", quality_filter),
    ("line dedup", drop_common_lines),
    ("near-dedup", keep_one_of_group),
    ("decontamination", decontaminate),
    ("packing", pack),
]

#: SQL can express neither the classifier nor the sketches nor the tokenizer; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if stage is not pack:
            docs = materialize(docs, "stage-" + name.replace(" ", "-"))
    return docs

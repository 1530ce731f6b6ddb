"""Benchmark decontamination with a distributed positional inverted index.

The index lists every place of every test word in the training texts, as rows
(document key, token, position). A phrase is looked up by its rarest word
first: each posting of that word, shifted by the word's place in the phrase,
is a possible start; the starts are intersected with the shifted postings of
the second rarest word and what is left with those of all other words. All
steps are DataFrame joins; no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelake.llm.common import Scratch, materialize, small

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Words of a text, A-Z lower-cased; null text: no words."""
    words = F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0))
    return F.coalesce(words, F.array().cast("array<string>"))


def test_words(items: DataFrame, window: int, write=materialize) -> tuple[DataFrame, DataFrame]:
    """(vocabulary: token, tid; windows: item_id, at, len, words), both written.

    A window is ``window`` consecutive words; a shorter item, but not one
    without words, is one window. tid 0 is kept for the row that each document
    has besides its postings.
    """
    listed = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), words_of(F.col("text")).alias("w"))
    listed = listed.where(F.size("w") > 0).distinct()
    # an id that is used by several texts stands for all of them
    listed = listed.withColumn("item", F.xxhash64("item_id", "w"))
    vocabulary = listed.select(F.explode("w").alias("token")).distinct()
    vocabulary = vocabulary.select("token", (F.monotonically_increasing_id() + 1).alias("tid"))
    vocabulary = write(vocabulary, "test-vocabulary")
    places = F.posexplode(F.expr(f"transform(sequence(0, greatest(0, size(w) - {window})), s -> slice(w, s + 1, {window}))"))
    windows = listed.select("item_id", "item", places.alias("at", "words"))
    return vocabulary, write(windows.withColumn("len", F.size("words")), "test-windows")


def build_index(docs: DataFrame, vocabulary: DataFrame, id_col: str = "doc_id", text_col: str = "text", write=materialize) -> DataFrame:
    """Positional postings (doc, h, tid, pos) of the vocabulary's words, written.

    (doc, h): the id and a hash of the text. Rows that share both share their
    result, so repeated rows are harmless. Every document also has the row
    (tid 0, pos = its number of words). Words of no test item are not stored:
    no phrase asked for has them.
    """
    docs = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63))).alias("doc"), F.col(text_col).alias("text"))
    tokens = docs.select("doc", F.xxhash64("text").alias("h"), F.posexplode(F.concat(words_of(F.col("text")), F.array(F.lit("")))).alias("pos", "token"))
    known = vocabulary.unionByName(vocabulary.sparkSession.createDataFrame([("", 0)], "token string, tid long"))
    known = small(write(known.select("token", "tid"), "index-vocabulary"))
    return write(tokens.join(known, "token").select("doc", "h", "tid", "pos"), "postings")


def phrase_matches(index: DataFrame, vocabulary: DataFrame, windows: DataFrame, write=materialize) -> DataFrame:
    """Exact occurrences of the windows: distinct (doc, h, item_id, start, len)."""
    frequency = index.groupBy("tid").agg(F.count(F.lit(1)).alias("f"))
    terms = windows.select("item_id", "item", "at", "len", F.posexplode("words").alias("o", "token"))
    terms = terms.join(vocabulary, "token").join(frequency, "tid", "left")
    terms = terms.select("item_id", "item", "at", "len", (F.col("at") + F.col("o")).alias("ipos"), "tid", F.coalesce("f", F.lit(0)).alias("f"))
    rank = Window.partitionBy("item", "at").orderBy("f", "ipos")
    terms = write(terms.withColumn("r", F.row_number().over(rank)), "test-terms")

    # all below come from the benchmark alone and are broadcast only if counted small
    found = terms.where("r = 1 AND f > 0")
    rarest = small(write(found.select("item", F.col("ipos").alias("i1"), "tid").distinct(), "rarest"))
    first = found.select("item_id", "item", "at", "len", F.col("ipos").alias("i1"))
    # a window of one word has it as its second too, one of two its rarest as the other: each is asked for something
    second = terms.where("r = least(2, len)").select("item", "at", F.col("ipos").alias("i2"), F.col("tid").alias("t2"))
    pairs = write(first.join(second, ["item", "at"]), "rarest-pairs")
    next_word = small(write(pairs.select("item", "i1", "i2", "t2").distinct(), "second-words"))
    whole = small(write(pairs.select("item_id", "item", "at", "len", "i1", "i2"), "window-pairs"))
    others = terms.where("r > 2 OR (r = 1 AND len <= 2)")
    rest = small(write(others.select("item", F.col("at").alias("w"), "ipos", F.col("tid").alias("t3")), "other-words"))

    postings = index.where("tid > 0")
    place = ["doc", "h", "tid", "pos"]
    # 1. postings of the rarest word, as the place where the item would start
    starts = postings.join(rarest, "tid").select("doc", "h", "item", "i1", (F.col("pos") - F.col("i1")).alias("diag"))
    # 2. shifted postings of the second rarest
    asked = starts.join(next_word, ["item", "i1"])
    asked = asked.select("doc", "h", "item", "i1", "i2", "diag", F.col("t2").alias("tid"), (F.col("diag") + F.col("i2")).alias("pos"))
    agreed = asked.join(postings, place, "left_semi")
    candidates = agreed.join(whole, ["item", "i1", "i2"]).where(F.col("diag") + F.col("at") >= 0)
    candidates = candidates.select("doc", "h", "item_id", "item", "at", "len", "diag").distinct()
    # 3. shifted postings of all other words, in the plan of 2: its shuffle of the postings serves both
    wanted = candidates.join(rest, (candidates["item"] == rest["item"]) & (F.col("at") == F.col("w")))
    wanted = wanted.select("doc", "h", "item_id", candidates["item"], "at", "len", "diag", F.col("t3").alias("tid"), (F.col("diag") + F.col("ipos")).alias("pos"))
    present = wanted.join(postings, place, "left_semi")
    full = present.groupBy("doc", "h", "item_id", "item", "at", "len", "diag").agg(F.count(F.lit(1)).alias("n"))
    full = full.where("n = greatest(1, len - 2)")
    return full.select("doc", "h", "item_id", (F.col("diag") + F.col("at")).alias("start"), "len").distinct()


def proximity_matches(index: DataFrame, vocabulary: DataFrame, phrases: DataFrame, span: int) -> DataFrame:
    """Documents that hold all different words of a phrase within ``span`` words.

    ``phrases``: phrase_id, text. Returns distinct doc, h, phrase_id, start: the
    places of the phrase's rarest word from which every other word lies less
    than ``span`` positions off, on either side. Postings are paired through
    blocks of ``span`` positions, never word by word over a document.
    """
    words = phrases.select("phrase_id", F.explode(F.array_distinct(words_of(F.col("text")))).alias("token"))
    frequency = index.groupBy("tid").agg(F.count(F.lit(1)).alias("f"))
    need = words.groupBy("phrase_id").agg(F.count(F.lit(1)).alias("need"))
    terms = words.join(vocabulary, "token").join(frequency, "tid")
    terms = terms.withColumn("r", F.row_number().over(Window.partitionBy("phrase_id").orderBy("f", "tid"))).join(need, "phrase_id")
    terms = materialize(terms.select("phrase_id", "tid", "r", "need"), "proximity-terms")
    block = F.expr(f"pos div {span}")
    places = index.where("tid > 0").join(small(terms), "tid")
    anchors = places.where("r = 1").select("doc", "h", "phrase_id", F.col("pos").alias("start"), "need", F.explode(F.array(block - 1, block, block + 1)).alias("b"))
    others = places.where("r > 1").select("doc", "h", "phrase_id", "tid", "pos", block.alias("b")).distinct()
    near = anchors.join(others, ["doc", "h", "phrase_id", "b"]).where(F.abs(F.col("pos") - F.col("start")) < span)
    near = near.groupBy("doc", "h", "phrase_id", "start", "need").agg(F.count_distinct("tid").alias("n")).where("n = need - 1")
    single = places.where("r = 1 AND need = 1").select("doc", "h", "phrase_id", F.col("pos").alias("start"))
    return near.select("doc", "h", "phrase_id", "start").union(single).distinct()


def contamination(docs: DataFrame, items: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Contamination of every row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A word is hit if it lies inside any occurrence of a window. Null texts have
    no words. Repeated items and windows count once an item id; a null item id
    is listed as ''. Rows that repeat an id and its text have equal results;
    an id with several texts has a row each. Empty documents give no rows, an
    empty benchmark contaminates nothing.
    """
    tables = Scratch(docs.sparkSession)
    vocabulary, windows = test_words(items.select("item_id", "text"), window, tables.write)
    index = build_index(docs, vocabulary, id_col, text_col, tables.write)
    matches = tables.write(phrase_matches(index, vocabulary, windows, tables.write), "matches")
    rows = tables.write(index.where("tid = 0").select("doc", "h", F.col("pos").cast("long").alias("n_words")), "rows")
    tables.clear("matches", "rows")  # the result reads no posting
    # words covered by the windows, each counted once: what reaches past the ends so far
    order = Window.partitionBy("doc", "h").orderBy("start", "len", "item_id").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("len")
    matches = matches.withColumn("so_far", F.coalesce(F.max(end).over(order), F.lit(0)))
    fresh = F.greatest(F.lit(0), end - F.greatest("so_far", "start"))
    hits = matches.groupBy("doc", "h").agg(F.sum(fresh).alias("n_hit"), F.sort_array(F.collect_set("item_id")).alias("ids"))
    out = rows.join(hits, ["doc", "h"], "left").withColumn("n_hit", F.coalesce("n_hit", F.lit(0)).cast("long"))
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    return out.select(
        F.when(F.col("doc") != -(2**63), F.col("doc")).alias("doc_id"),
        F.col("h").alias("text_hash"),
        "n_words", "n_hit",
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )

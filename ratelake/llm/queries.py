"""The corpus operators as registered queries ``opN_<name>``, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake.llm import ann, langid, line_dedup, quality, simhash
from ratelake.llm.collocations import collocations
from ratelake.llm.common import crc_of_id, table
from ratelake.llm.decontam import contamination
from ratelake.llm.near_dup import near_duplicates
from ratelake.llm.packing import pack_documents
from ratelake.llm.pii import personal_data
from ratelake.llm.prefix_trie import prefix_trie
from ratelake.llm.sharding import shard_documents
from ratelake.llm.warc import archive

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op1_shard_jump(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))


@query
def op2_rp_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0))


@query
def op3_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("text_hash")


_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLES["op3_positional_index"] = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce({_WORDS}, []) AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark WHERE len({_WORDS}) > 0),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[s : s + 9], ' ') AS gram
  FROM b, LATERAL (SELECT unnest(range(1, greatest(1, len(w) - 9) + 1)) AS s)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT rid, n, s, array_to_string(w[s : s + n - 1], ' ') AS gram
  FROM d, sizes, LATERAL (SELECT unnest(range(1, len(w) - n + 2)) AS s)),
hit AS (SELECT dw.rid, dw.s, dw.n, bw.item_id FROM dw JOIN bw USING (n, gram)),
covered AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(s, s + n)) AS p FROM hit) GROUP BY rid),
items AS (SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT rid, item_id FROM hit) GROUP BY rid)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (rid) LEFT JOIN items USING (rid)
"""


@query
def op4_bootstrap_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


@query
def op5_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op6_host_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    kept = line_dedup.drop_boilerplate(docs, n_lines="n_lines", n_dropped="n_dropped")
    return kept.select("doc_id", "n_lines", "n_dropped", F.md5("text").alias("kept_md5"))


ORACLES["op6_host_lines"] = f"""
WITH pages AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(source, '') AS host, text FROM documents),
lines AS (
  SELECT rid, host, text, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM pages WHERE text IS NOT NULL),
totals AS (SELECT host, count(DISTINCT text) AS total FROM pages GROUP BY host),
bad AS (
  SELECT l.host, trim(l.line) AS line FROM lines l JOIN totals t USING (host)
  WHERE trim(l.line) <> '' GROUP BY l.host, trim(l.line), t.total
  HAVING count(DISTINCT l.text) >= {line_dedup.MIN_PAGES} AND count(DISTINCT l.text) > {line_dedup.MAX_RATIO} * t.total),
marked AS (SELECT l.*, b.line IS NOT NULL AS gone FROM lines l LEFT JOIN bad b ON b.host = l.host AND b.line = trim(l.line)),
kept AS (
  SELECT rid, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS text
  FROM marked GROUP BY rid)
SELECT p.doc_id, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_dropped, 0) AS n_dropped, md5(k.text) AS kept_md5
FROM pages p LEFT JOIN kept k USING (rid)
"""


@query
def op7_pack_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


@query
def op8_hyperdimensional(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_of_id("doc_id") % 5 == 0
    learned = langid.train(docs.where(~held_out))
    found = langid.identify(spark, docs, learned)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op9_lsa_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_of_id("doc_id") % 4 == 2
    sample = quality.labelled_sample(docs, table(spark, sf_dir, "labels"), ~held_out)
    score = quality.scorer(spark, quality.fit(sample))
    scored = docs.select("doc_id", held_out.alias("held_out"), score("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= quality.ACCEPT).cast("int"))


@query
def op10_capture_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive(table(spark, sf_dir, "pages")).drop("url")


ORACLES["op10_capture_index"] = r"""
WITH d AS (
  SELECT page_id, coalesce(html, '') AS payload, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id,
         array_to_string(list_transform(string_split(sha1(coalesce(html, '')), ''), lambda c:
           array_to_string(list_transform([3, 2, 1, 0], lambda b: ((strpos('0123456789abcdef', c) - 1) >> b) & 1), '')), '') AS bits
  FROM pages)
SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + list_reduce(list_transform(string_split(substr(bits, 5 * i + 1, 5), ''), lambda c: CAST(c AS INTEGER)), lambda a, b: 2 * a + b), 1)), '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM d
"""


@query
def op11_simhash_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


ORACLES["op12_prefix_trie"] = r"""
WITH crc AS (
  SELECT list_transform(range(256), lambda x: list_reduce([x] || [0, 0, 0, 0, 0, 0, 0, 0],
           lambda c, i: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END)) AS t),
turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         dense_rank() OVER (ORDER BY coalesce(role, ''), coalesce(text, '')) AS id,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS rank
  FROM conversations WHERE conv_id IS NOT NULL),
words AS (SELECT DISTINCT id, len(regexp_extract_all(text, '[^ 	-
]+')) AS tokens FROM turns),
own AS (SELECT conv_id, list(id ORDER BY rank) AS ids FROM turns GROUP BY conv_id),
heads AS (
  SELECT conv_id, ids, xor(4294967295, list_reduce([4294967295] || list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
         lambda c, b: xor(c // 256, t[1 + xor(c, b) % 256]))) % 4 AS h
  FROM own, crc),
convs AS (
  SELECT c.conv_id, coalesce(b.ids[1:c.h], []) || c.ids[c.h + 1:len(c.ids)] AS path
  FROM heads c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 20),
steps AS (SELECT conv_id, path[1:d] AS prefix FROM convs, LATERAL (SELECT unnest(range(0, len(path) + 1)) AS d)),
nodes AS (SELECT prefix, len(prefix) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs FROM steps GROUP BY prefix),
children AS (SELECT prefix[1:depth - 1] AS prefix, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
valued AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * coalesce(tokens, 0) AS own
  FROM nodes n LEFT JOIN children USING (prefix) LEFT JOIN words w ON w.id = n.prefix[n.depth]),
subtrees AS (
  SELECT prefix[1:d] AS prefix, count(*) FILTER (n_children = 0) AS n_leaves, CAST(sum(own) AS BIGINT) AS saved_tokens
  FROM valued, LATERAL (SELECT unnest(range(0, depth + 1)) AS d) GROUP BY 1),
ends AS (SELECT path AS prefix, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids FROM convs GROUP BY path)
SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children, s.n_leaves, s.saved_tokens,
       sha256(coalesce(e.ids, '')) AS ends_sha256
FROM valued v JOIN subtrees s USING (prefix) LEFT JOIN ends e USING (prefix)
LEFT JOIN nodes p ON v.depth > 0 AND p.prefix = v.prefix[1:v.depth - 1]
"""


@query
def op13_count_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLES["op13_count_automata"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-
]')) AS piece
  FROM documents WHERE text IS NOT NULL),
listed AS (SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS w FROM pieces),
grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
  FROM listed, (SELECT unnest([1, 2, 3, 4]) AS k), LATERAL (SELECT unnest(range(1, len(w) - k + 2)) AS i)
  GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM grams WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM grams WHERE k > 1 AND f >= 30),
cuts AS (
  SELECT c.lang, c.phrase, a, cut, l.f AS l, r.f AS r, CAST(CAST(2000000 AS HUGEINT) * a // (l.f + r.f) AS BIGINT) AS score
  FROM candidates c, LATERAL (SELECT unnest(range(1, c.k)) AS cut)
  JOIN grams l ON l.lang = c.lang AND l.phrase = array_to_string(w[1:cut], ' ')
  JOIN grams r ON r.lang = c.lang AND r.phrase = array_to_string(w[cut + 1:], ' ')),
scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer
  FROM candidates c, (SELECT unnest([2, 3]) AS m), LATERAL (SELECT unnest(range(1, c.k - m + 2)) AS i)
  WHERE m < c.k GROUP BY ALL),
kept AS (SELECT s.* FROM scored s LEFT JOIN inside i USING (lang, phrase) WHERE longer IS NULL OR CAST(100 AS HUGEINT) * longer < CAST(80 AS HUGEINT) * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000
"""

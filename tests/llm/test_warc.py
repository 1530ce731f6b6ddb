import base64
import gzip
import hashlib

from llm_helpers import sentence
from pyspark.sql import functions as F
from ratelake.llm.common import scratch_dir
from ratelake.llm.warc import Reader, archive, locate, parse, read_records, record, url_key, write_archives, write_index

PAGES = "page_id long, url string, html string, file string, offset long, key string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "f", 1, "k") for r in rows], PAGES).repartition(4)


ROWS = [(i, f"http://www.site{i % 5}.example.com:80/p/{i}?q=1#x", f"<html>é {sentence(i, 20)}</html>") for i in range(60)]
ROWS += [(100 + i, f"https://copy.example.org/{i}", "<p>same</p>") for i in range(25)]
ROWS += [(200, None, "<p>no url</p>"), (201, "not a url\r\nX: y", None), (202, "http://e.com", ""), (None, "http://n.com/", "<p>same</p>"), (203, "HTTP://User@E.com/Path", "z" * 400_000)]


def expected(rows):
    best = {}
    for i, _, html in rows:
        best[html or ""] = max(best.get(html or "", -1), -1 if i is None else i)
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        own = (-1 if i is None else i) == best[html or ""]
        out.append((str(i), len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if own else "revisit", None if own else best[html or ""]))
    return sorted(out, key=str)


def test_archive_round_trip(spark):
    got = archive(pages(spark, ROWS), block_lines=7).collect()
    assert sorted(((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == expected(ROWS)
    assert archive(pages(spark, ROWS).where("false")).count() == 0


def test_repeated_rows_have_a_record_each(spark):
    rows = [(1, "http://a.com/", "x"), (1, "http://a.com/", "x"), (2, "http://a.com/", "y"), (1, "http://b.com/", "z")]
    got = archive(pages(spark, rows), block_lines=1).collect()
    assert sorted((r.page_id, r.url, r.payload_bytes, r.record_type) for r in got) == sorted((i, u, 1, "response") for i, u, _ in rows)


def test_two_level_lookup_and_payloads(spark):
    table = pages(spark, ROWS)
    archives, folder = scratch_dir(spark, "warc-test"), scratch_dir(spark, "index-test")
    manifest = write_archives(table, archives)
    index = write_index(manifest, folder, archives, block_lines=4)
    entries = [tuple(r) for r in index.directory.collect()]
    assert len(entries) >= len(ROWS) / 4 and len(entries) < len(ROWS)
    reader = Reader(folder, entries)
    every = sorted(tuple(r) for r in manifest.collect())
    assert sorted(x for d in range(len(entries)) for x in ((*r[:3], int(r[3]), int(r[4])) for r in reader._load(d))) == every
    for key in {r[0] for r in every}:
        assert sorted(reader.find(key)) == [r for r in every if r[0] == key]
    assert reader.find("com,example,nowhere)/") == [] and reader.find("") == [r for r in every if r[0] == ""]
    wanted = table.where("page_id < 60").select(url_key(F.col("url")).alias("key"), F.col("page_id").cast("string").alias("page"))
    back = read_records(archives, locate(spark, index, wanted), with_payload=True).collect()
    assert {r.page_id: r.html for r in back} == {i: h for i, _, h in ROWS if i is not None and i < 60}


def test_url_keys(spark):
    urls = ["http://www.Example.com/A?b=1#c", "https://u:p@h.org:8080", "//x.y/z", "plain text", None, "http://a.com?q"]
    frame = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [r[0] for r in frame.select(url_key(F.col("u"))).collect()] == ["com,example,www)/A?b=1", "org,h)/", "y,x)/z", ")plain text", "", "com,a)?q"]


def test_record_bytes():
    data = record("5", "http://a/\r\nB: c", "é".encode(), None, "2020-01-01T00:00:00Z")
    r = parse(gzip.decompress(gzip.compress(data)))
    assert r["payload"] == "é".encode() and r["payload_bytes"] == 2 and r["warc-target-uri"] == "http://a/%0D%0AB: c" and "b" not in r
    r = parse(record("5", None, b"xyz", "9", "2020-01-01T00:00:00Z"))
    assert r["payload"] is None and r["payload_bytes"] == 3 and r["warc-refers-to"] == "<urn:x-page:9>"


def test_folders_by_the_names_of_hadoop():
    from ratelake.llm.warc import arrow_uri

    assert arrow_uri("s3a://bucket/a b/c") == "s3://bucket/a b/c"
    assert arrow_uri("dbfs:/tmp/x") == "file:///dbfs/tmp/x"
    assert arrow_uri("file:///tmp/x") == "file:///tmp/x" and arrow_uri("/tmp/x") == "/tmp/x"

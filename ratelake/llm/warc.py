"""WARC archives with a two-level capture index.

Archives hold one gzip member a record, so a record can be read by its byte
range alone. The index sorts captures by reversed-host URL key into compressed
blocks; a sparse directory holds the first key of each block. A look-up
binary-searches the directory, reads one block by range, binary-searches the
block and reads the record by range.

Files are written by the tasks through ``pyarrow.fs`` to the shared folder. A
task's file has a name of its own for each attempt and counts only by the rows
the task returns, so lost executors and repeated tasks leave no trace in the
manifest.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake.llm.common import materialize, scratch_dir, small

# Record and profile names of the WARC format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Blocks grow beyond ``block_lines`` so that the directory has at most about so many entries.
MAX_DIRECTORY = 500_000


def url_key(url: Column) -> Column:
    """Reversed-host key of a URL: ``com,example,www)/path?query``; null: ''.

    Scheme, user, port and fragment are left out, the host is lower-cased; a
    text without a host is kept as it is behind ``)``.
    """
    parts = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/:?#]*)(?::[0-9]*)?([^#]*)"
    host = F.array_join(F.reverse(F.split(F.lower(F.regexp_extract(url, parts, 1)), r"\.")), ",")
    rest = F.regexp_extract(url, parts, 2)
    key = F.when(url.rlike(parts), F.concat(host, F.lit(")"), F.when(rest == "", F.lit("/")).otherwise(rest))).otherwise(F.concat(F.lit(")"), url))
    return F.coalesce(F.translate(key, "\t\r\n", "   "), F.lit(""))


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


#: Hadoop's names of stores that the archives' reader knows by another name.
ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def arrow_uri(uri: str) -> str:
    """A folder as the tasks' file system names it.

    ``dbfs:/x`` is the mount ``/dbfs/x``. Stores that are neither here nor known
    to pyarrow (``viewfs``) fail with its message; ``hdfs`` needs libhdfs on the
    workers.
    """
    scheme, found, rest = uri.partition(":")
    if scheme == "dbfs":
        return "file:///dbfs/" + rest.lstrip("/")
    return f"{ARROW_SCHEMES.get(scheme, scheme)}{found}{rest}"


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(arrow_uri(uri))


def record(page_id: str | None, url: str | None, payload: bytes, refers_to: str | None, date: str) -> bytes:
    """One WARC record: response, or revisit if ``refers_to`` is given.

    A revisit keeps the HTTP header (and so the payload's length) without the
    payload. Line breaks in a URL are escaped.
    """
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = [VERSION, f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:x-page:{page_id or ''}>"]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    lines += [f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest_of(payload)}"]
    if refers_to is not None:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:x-page:{refers_to}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """Fields of a record: headers (lower-case names), payload (None for a revisit), payload_bytes."""
    head, _, body = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
    block = body[: int(headers["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    revisit = headers["warc-type"] == "revisit"
    if not revisit and (len(payload) != length or headers["warc-payload-digest"] != f"sha1:{digest_of(payload)}"):
        raise ValueError("payload doesn't match its record")
    return headers | {"payload": None if revisit else payload, "payload_bytes": length}


def write_archives(pages: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write a record for every row (page_id, url, html); returns the manifest, written.

    Manifest: key, page (id as text, null: ''), file, offset, length. Of rows
    with equal payloads (null html: empty) those with the largest page_id are
    responses, the others revisit it; null ids are smaller than all others.
    Rows that share that largest id and the payload are all responses.
    The pages are not shuffled: payloads met more than once are found by a
    narrow aggregation and joined to the rows, broadcast if counted few.
    """
    spark = pages.sparkSession
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("sha", F.unhex(F.sha1("html")))
    groups = rows.groupBy("sha").agg(F.max("page_id").alias("largest"), F.count(F.lit(1)).alias("n")).where("n > 1")
    groups = small(materialize(groups.select("sha", "largest"), "repeated-payloads"))
    rows = rows.join(groups, "sha", "left")
    refers = F.when(F.col("largest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("largest")), F.col("largest"))
    rows = rows.select(
        F.coalesce(F.col("page_id").cast("string"), F.lit("")).alias("page"), "url", url_key(F.col("url")).alias("key"),
        "html", refers.cast("string").alias("refers"),
    )

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, path = _filesystem(folder)
        system.create_dir(path, recursive=True)
        task = TaskContext.get()
        name = f"pages-{task.partitionId():06d}-{uuid.uuid4().hex[:12]}.warc.gz"
        at = 0
        out = None
        try:
            for batch in batches:
                places = []
                for page, url, html, refers in zip(batch["page"], batch["url"], batch["html"], batch["refers"]):
                    refers = refers if isinstance(refers, str) else None
                    url = url if isinstance(url, str) else None
                    member = gzip.compress(record(page, url, html.encode(), refers, date), 1, mtime=0)
                    out = out or system.open_output_stream(f"{path}/{name}", compression=None)
                    out.write(member)
                    places.append((at, len(member)))
                    at += len(member)
                if places:
                    found = pd.DataFrame(places, columns=["offset", "length"])
                    found.insert(0, "file", name)
                    found.insert(0, "page", batch["page"].to_numpy())
                    found.insert(0, "key", batch["key"].to_numpy())
                    yield found
        finally:
            if out:
                out.close()

    manifest = rows.mapInPandas(write, "key string, page string, file string, offset long, length long")
    return materialize(manifest, "warc-manifest")


@dataclass
class Index:
    """A written capture index: the folder of its blocks and the written directory."""

    folder: str
    archives: str
    directory: DataFrame


def write_index(manifest: DataFrame, folder: str, archives: str, block_lines: int = 2000) -> Index:
    """Sort the captures by (key, page) into compressed blocks and keep the directory.

    Directory: key, page (of a block's first line), file, offset, length. The
    sort is a range shuffle of narrow rows; each task writes its range as one
    file of blocks.
    """
    lines = max(block_lines, -(-manifest.count() // MAX_DIRECTORY))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, path = _filesystem(folder)
        system.create_dir(path, recursive=True)
        name = f"index-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}.gz"
        entries: list[tuple] = []
        held: list[str] = []
        first = None
        at = 0
        out = None

        def flush():
            nonlocal held, at, out
            out = out or system.open_output_stream(f"{path}/{name}", compression=None)
            data = gzip.compress("\n".join(held).encode(), 6, mtime=0)
            out.write(data)
            entries.append((*first, name, at, len(data)))
            at += len(data)
            held = []

        try:
            for b in batches:
                for row in zip(b["key"], b["page"], b["file"], b["offset"], b["length"]):
                    if not held:
                        first = row[:2]
                    held.append("\t".join(map(str, row)))
                    if len(held) >= lines:
                        flush()
            if held:
                flush()
        finally:
            if out:
                out.close()
        if entries:
            yield pd.DataFrame(entries, columns=["key", "page", "file", "offset", "length"])

    ranged = manifest.repartitionByRange("key", "page").sortWithinPartitions("key", "page", "file", "offset")
    directory = materialize(ranged.mapInPandas(write, "key string, page string, file string, offset long, length long"), "warc-directory")
    return Index(folder, archives, directory)


class Reader:
    """Look-ups in an index; keeps the last block."""

    def __init__(self, folder: str, directory: list[tuple]):
        self.system, self.path = _filesystem(folder)
        self.directory = sorted(directory)
        self.firsts = [d[:2] for d in self.directory]
        self.at, self.block = -1, []

    def _load(self, i: int) -> list[tuple]:
        if i != self.at:
            _, _, name, offset, length = self.directory[i]
            with self.system.open_input_file(f"{self.path}/{name}") as f:
                text = gzip.decompress(f.read_at(length, offset)).decode()
            self.at, self.block = i, [tuple(line.split("\t")) for line in text.split("\n")]
        return self.block

    def find(self, key: str, page: str | None = None) -> list[tuple[str, str, str, int, int]]:
        """Captures of a key (of one page id, if given): key, page, file, offset, length."""
        low = (key,) if page is None else (key, page)
        out = []
        # the block before the first one that begins at or after the key may hold it too
        for i in range(max(0, bisect.bisect_left(self.firsts, low) - 1), len(self.directory)):
            if self.firsts[i][: len(low)] > low:
                break
            block = self._load(i)
            for row in block[bisect.bisect_left(block, low) :]:
                if row[: len(low)] != low:
                    break
                out.append((*row[:3], int(row[3]), int(row[4])))
        return out


def locate(spark: SparkSession, index: Index, wanted: DataFrame) -> DataFrame:
    """Captures of the wanted (key, page): key, page, file, offset, length.

    The look-ups are sorted, so a task meets each block once. The directory is
    broadcast: at most about MAX_DIRECTORY entries, by the choice of block size.
    """
    entries = [tuple(r) for r in index.directory.collect()]
    shared = spark.sparkContext.broadcast(entries)
    folder = index.folder

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = None
        for b in batches:
            reader = reader or Reader(folder, shared.value)
            found = [x for key, page in zip(b["key"], b["page"]) for x in reader.find(key, page)]
            yield pd.DataFrame(found, columns=["key", "page", "file", "offset", "length"])

    ranged = wanted.select("key", "page").distinct().repartitionByRange("key", "page").sortWithinPartitions("key", "page")
    return ranged.mapInPandas(search, "key string, page string, file string, offset long, length long")


def read_records(archives: str, places: DataFrame, with_payload: bool = False) -> DataFrame:
    """Read records by range: page_id, url, payload_bytes, payload_digest, record_type, refers_to[, html].

    Places are grouped by archive and read in order of offset. A response's
    digest and length are computed from the payload read.
    """
    # ids travel as text: whole numbers with nulls would turn to floats in pandas
    schema = "page_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string, html string"

    def number(urn: str | None):
        return (urn or "")[len("<urn:x-page:") : -1] or None

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, path = _filesystem(archives)
        name, file = None, None
        for b in batches:
            rows = []
            for own, offset, length in zip(b["file"], b["offset"], b["length"]):
                if own != name:
                    if file:
                        file.close()
                    name, file = own, system.open_input_file(f"{path}/{own}")
                r = parse(zlib.decompress(file.read_at(int(length), int(offset)), 31))
                html = r["payload"].decode() if with_payload and r["payload"] is not None else None
                rows.append((
                    number(r["warc-record-id"]), r.get("warc-target-uri"), r["payload_bytes"],
                    r["warc-payload-digest"].removeprefix("sha1:"), r["warc-type"], number(r.get("warc-refers-to")), html,
                ))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])
        if file:
            file.close()

    # a number, so the narrow places are not coalesced into few tasks: reading the records is the work
    tasks = int(places.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grouped = places.repartition(tasks, "file").sortWithinPartitions("file", "offset")
    out = grouped.select("file", "offset", "length").mapInPandas(read, schema)
    out = out.withColumns({c: F.col(c).cast("long") for c in ("page_id", "refers_to")})
    return out if with_payload else out.drop("html")


def archive(pages: DataFrame, block_lines: int = 2000, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write all pages to archives, index them, look every page up and read it back.

    One row per page. Null html is an empty payload, a null url has the key '',
    null ids come back null; repeated ids have a record each. Other columns are
    not read. An empty table gives no rows (and no files).
    """
    spark = pages.sparkSession
    pages = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    archives, folder = scratch_dir(spark, "warc"), scratch_dir(spark, "warc-index")
    index = write_index(write_archives(pages, archives), folder, archives, block_lines)
    wanted = pages.select(url_key(F.col("url")).alias("key"), F.coalesce(F.col("page_id").cast("string"), F.lit("")).alias("page"))
    return read_records(archives, locate(spark, index, wanted))

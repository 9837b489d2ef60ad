"""WARC archives of pages and a two-level capture index over them.

Archives: every task writes one WARC/1.1 file of gzip members, one member per record, into a shared
folder through the file system its URI names. Of records with equal payloads of ``REVISIT_BYTES``
or more, the one with the largest id is a response, the others are revisits that name it.

Index: one line per record (reversed-host URL key, id, type, file, offset, length, digest, size),
sorted by key and id over all shards by range partitioning. A shard file holds the lines in
compressed blocks of ``BLOCK_LINES``; beside it lies the sparse directory: first key, offset and
length of each block. The first key of each shard is what the driver keeps.

Lookup: a URL's key is found by binary search over the shards' first keys, then over the shard's
directory, then in the block that one range read fetched; records are fetched by range reads sorted
by file and offset, neighbours together.

File names carry the task attempt. Only files of attempts whose output Spark committed are named by
an index line, so a lost executor or a repeated task leaves nothing but an unread file.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.llm.common import ready
from kiln.session import ensure_checkpoint_dir, staged

REVISIT_BYTES = 1000
BLOCK_LINES = 1000
# Neighbouring records are fetched in one read up to this many bytes.
READ_BYTES = 4 << 20
# Archive bytes that one task reads back, and the tasks that read at least.
PART_BYTES, LEAST_READERS = 64 << 20, 16
GZIP_LEVEL = 4
RECORD_TIME = "1970-01-01T00:00:00Z"

CAPTURE = ("key string, id long, url string, type string, refers_to long, digest string, size long, "
           "file string, offset long, length long")
NAMES = ["key", "id", "url", "type", "refers_to", "digest", "size", "file", "offset", "length"]


def url_key(url: str | None) -> str:
    """Host labels in reverse, then path and query, in lower case; null and empty urls have the empty key."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return url.strip().lower()
    key = ",".join(reversed(host.split("."))) + (f":{port}" if port else "") + ")" + (parts.path or "/")
    return (key + ("?" + parts.query if parts.query else "")).lower()


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder URI or local path."""
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def warc_record(kind: str, page: int, url: str, payload: bytes, digest: str, size: int, refers_to: int | None) -> bytes:
    """One WARC record, uncompressed; a revisit carries no payload."""
    clean = "".join(c for c in (url or "") if c >= " " and c != "\x7f")
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{page}>", f"WARC-Date: {RECORD_TIME}",
            f"WARC-Target-URI: {clean}", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {size}"]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:page:{refers_to}>"]
        payload = b""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(http)}"]
    return b"WARC/1.1\r\n" + "\r\n".join(head).encode("utf-8", "replace") + b"\r\n\r\n" + http + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and payload of one uncompressed record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    headers = {k.lower(): v for k, v in (x.split(": ", 1) for x in lines[1:])}
    body = rest[: int(headers["content-length"])]
    return headers, body.partition(b"\r\n\r\n")[2]


def _page_number(urn: str) -> int:
    return int(urn.rpartition(":")[2].rstrip(">"))


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write every row as a record below ``folder``; returns the captures (``CAPTURE`` columns) as written.

    Null html is an empty payload; a null id is written as -1. Rows that repeat an id are written again;
    the revisited response is then the records with that id and digest.
    """
    ready(pages.sparkSession)
    rows = pages.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-1)).alias("id"), F.col(url).alias("url"),
                        F.coalesce(F.col(html), F.lit("")).cast("binary").alias("body"))
    digests = staged(rows.where(F.length("body") >= REVISIT_BYTES).select("id", F.sha1("body").alias("digest")), "digests")
    last = staged(digests.groupBy("digest").agg(F.max("id").alias("kept"), F.count("*").alias("c"))
                  .where("c > 1").select("digest", "kept"), "repeated")
    revisits = staged(digests.join(last, "digest").where("id <> kept").select("id", "digest", "kept").distinct(), "revisits")
    # Only ids of revisits meet the pages; the digest keeps rows apart that repeat an id.
    full = (rows.withColumn("digest", F.sha1("body")).join(revisits, ["id", "digest"], "left")
            .select("id", "url", "kept", "digest", "body"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        ctx = TaskContext.get()
        system, path = open_folder(folder)
        system.create_dir(path, recursive=True)
        name = f"pages-{ctx.partitionId():06d}-{ctx.taskAttemptId()}-{uuid.uuid4().hex[:8]}.warc.gz"
        out, at = None, 0
        for b in batches:
            if out is None:
                out = system.open_output_stream(f"{path}/{name}", compression=None)
            got = {n: [] for n in NAMES}
            for i, u, kept, digest, body in zip(*(c.to_pylist() for c in b.columns)):
                kind = "response" if kept is None else "revisit"
                member = gzip.compress(warc_record(kind, i, u, body, digest, len(body), kept), GZIP_LEVEL, mtime=0)
                out.write(member)
                for n, v in zip(NAMES, (url_key(u), i, u, kind, kept, digest, len(body), name, at, len(member))):
                    got[n].append(v)
                at += len(member)
            yield pa.RecordBatch.from_pydict(got, CAPTURE_ARROW)
        if out is not None:
            out.close()

    return staged(full.mapInArrow(write, CAPTURE), "captures")


CAPTURE_ARROW = pa.schema([(n, pa.int64() if t == "long" else pa.string())
                           for n, t in (c.strip().split(" ") for c in CAPTURE.split(","))])


def write_index(captures: DataFrame, folder: str, shards: int | None = None) -> DataFrame:
    """Write the sorted index shards; returns one row per shard (first_key, first_id, file, blocks, lines), in order."""
    spark = ready(captures.sparkSession)
    n = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = captures.repartitionByRange(n, "key", "id", "file", "offset").sortWithinPartitions("key", "id", "file", "offset")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        ctx = TaskContext.get()
        system, path = open_folder(folder)
        system.create_dir(path, recursive=True)
        name = f"index-{ctx.partitionId():06d}-{ctx.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        out, at, directory, held, lines, first = None, 0, [], [], 0, None

        def block():
            nonlocal at
            data = zlib.compress("\n".join(json.dumps(list(r)) for r in held).encode("utf-8"), GZIP_LEVEL)
            out.write(data)
            directory.append([held[0][0], at, len(data)])
            at += len(data)

        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if out is None:
                    out = system.open_output_stream(f"{path}/{name}.blocks", compression=None)
                    first = row[:2]
                held.append(row)
                lines += 1
                if len(held) == BLOCK_LINES:
                    block()
                    held = []
        if out is None:
            return
        if held:
            block()
        out.close()
        with system.open_output_stream(f"{path}/{name}.directory", compression=None) as f:
            f.write("\n".join(json.dumps(d) for d in directory).encode("utf-8"))
        yield pa.RecordBatch.from_arrays(
            [pa.array([first[0]]), pa.array([first[1]], pa.int64()), pa.array([name]),
             pa.array([len(directory)], pa.int32()), pa.array([lines], pa.int64())],
            ["first_key", "first_id", "file", "blocks", "lines"])

    return staged(ordered.select(*NAMES).mapInArrow(write, "first_key string, first_id long, file string, blocks int, lines long"), "shards")


class IndexReader:
    """Lookups in the index shards of a folder."""

    def __init__(self, folder: str, shards: list[tuple[str, str]]):
        """shards: (first key, file) in order; one per index task."""
        self.system, self.path = open_folder(folder)
        self.first = [k for k, _ in shards]
        self.files = [f for _, f in shards]
        self.held: tuple[int, list, object] | None = None
        self.block: tuple[tuple[int, int], list] | None = None

    def _shard(self, s: int):
        if self.held is None or self.held[0] != s:
            with self.system.open_input_file(f"{self.path}/{self.files[s]}.directory") as f:
                directory = [json.loads(x) for x in f.read().decode("utf-8").split("\n")]
            self.held = (s, directory, self.system.open_input_file(f"{self.path}/{self.files[s]}.blocks"))
        return self.held[1], self.held[2]

    def _lines(self, s: int, b: int) -> list:
        if self.block is None or self.block[0] != (s, b):
            directory, f = self._shard(s)
            _, at, length = directory[b]
            f.seek(at)
            data = zlib.decompress(f.read(length)).decode("utf-8")
            self.block = ((s, b), [json.loads(x) for x in data.split("\n")])
        return self.block[1]

    def lookup(self, key: str) -> Iterator[list]:
        """Index lines of a key in order; equal keys may go on over blocks and shards."""
        s = max(0, bisect.bisect_left(self.first, key) - 1)
        while s < len(self.files) and self.first[s] <= key:
            directory, _ = self._shard(s)
            keys = [d[0] for d in directory]
            b = max(0, bisect.bisect_left(keys, key) - 1)
            while b < len(keys) and keys[b] <= key:
                lines = self._lines(s, b)
                for k in range(bisect.bisect_left(lines, key, key=lambda r: r[0]), len(lines)):
                    if lines[k][0] != key:
                        return
                    yield lines[k]
                b += 1
            s += 1


def lookup_urls(urls: DataFrame, shards: DataFrame, folder: str, url: str = "url") -> DataFrame:
    """The captures of every distinct url key asked for, through the index (``CAPTURE`` columns).

    The shards' first keys are collected: one row per index task, however many pages there are.
    """
    spark = ready(urls.sparkSession)
    order = [(r["first_key"], r["file"]) for r in shards.orderBy("first_key", "first_id", "file").collect()]
    if not order:
        return spark.createDataFrame([], CAPTURE)
    held = spark.sparkContext.broadcast(order)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([url_key(u) for u in b.column(0).to_pylist()])], ["key"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, got = IndexReader(folder, held.value), []
        for b in batches:
            for key in b.column("key").to_pylist():
                for line in reader.lookup(key):
                    got.append(line)
                    if len(got) == 4096:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*got), CAPTURE_ARROW.types)], NAMES)
                        got = []
        if got:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*got), CAPTURE_ARROW.types)], NAMES)

    asked = urls.select(F.col(url)).mapInArrow(keys, "key string").distinct()
    # Neighbouring keys go to one task, which so reads each block about once.
    return asked.repartitionByRange("key").sortWithinPartitions("key").mapInArrow(search, CAPTURE)


def read_records(captures: DataFrame, folder: str) -> DataFrame:
    """(id, url, type, refers_to, digest, size, payload, payload_sha1) of captures, read from the archives.

    payload is the archived payload; a revisit has none (null). digest and size describe the full payload;
    payload_sha1 is computed from the bytes read (null for revisits).
    """
    ready(captures.sparkSession)
    schema = ("id long, url string, type string, refers_to long, digest string, size long, payload binary, "
              "payload_sha1 string")
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.string()]
    names = ["id", "url", "type", "refers_to", "digest", "size", "payload", "payload_sha1"]

    def fetch(system, path, rows):
        with system.open_input_file(f"{path}/{rows[0][0]}") as f:
            f.seek(rows[0][1])
            data = f.read(rows[-1][1] + rows[-1][2] - rows[0][1])
        out = []
        for _, offset, length in rows:
            headers, payload = parse_record(gzip.decompress(data[offset - rows[0][1]:offset - rows[0][1] + length]))
            kind = headers["warc-type"]
            revisit = kind == "revisit"
            out.append((_page_number(headers["warc-record-id"]), headers["warc-target-uri"], kind,
                        _page_number(headers["warc-refers-to"]) if revisit else None,
                        headers["warc-payload-digest"].removeprefix("sha1:"), int(headers["x-payload-length"]),
                        None if revisit else payload, None if revisit else hashlib.sha1(payload).hexdigest()))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = open_folder(folder)
        held: list[tuple[str, int, int]] = []
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if held and (row[0] != held[0][0] or row[1] != held[-1][1] + held[-1][2]
                             or row[1] + row[2] - held[0][1] > READ_BYTES):
                    yield fetch(system, path, held)
                    held = []
                held.append(row)
        if held:
            yield fetch(system, path, held)

    spots = staged(captures.select("file", "offset", "length").distinct(), "spots")
    # The rows are tiny, what they stand for is not: as many tasks as the records' bytes ask for.
    tasks = max(LEAST_READERS, -(-(spots.agg(F.sum("length")).first()[0] or 0) // PART_BYTES))
    return (spots.repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset").mapInArrow(read, schema))


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def op9_warc(spark, sf_dir: str) -> DataFrame:
    """Archive ``pages``, index the archives, look every url up and read its records back."""
    from kiln.sources.tables import table

    ready(spark)
    pages, folder = table(spark, sf_dir, "pages"), new_folder(spark, "warc")
    shards = write_index(write_archives(pages, folder), folder)
    records = read_records(lookup_urls(pages, shards, folder), folder)
    return records.select(
        F.expr("nullif(id, -1L)").alias("page_id"), F.col("size").alias("payload_bytes"),
        F.coalesce("payload_sha1", "digest").alias("payload_digest"), F.col("type").alias("record_type"), "refers_to")


OP9_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, octet_length(body) AS n, sha1(body) AS digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY digest) AS kept FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN n >= 1000 AND page_id <> kept THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id <> kept THEN kept END AS refers_to
FROM m
"""

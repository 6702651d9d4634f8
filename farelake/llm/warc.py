"""WARC archives: parallel writer and sequential reader.

``write_warc`` turns rows into WARC/1.1 records, one gzip member a record, in
archives of bounded size. Each task writes its archives straight to a shared
folder through Arrow's file systems (local, HDFS, object stores), under names
unique to the attempt, and reports them as rows; the manifest is committed by
Spark, so archives of lost or repeated attempts are never listed nor read.

Of rows with equal payloads of at least ``MIN_REVISIT`` bytes, the one with
the largest id is written as a response and the others as revisits of it,
without payload. The choice is an aggregate by digest (partial sums first)
joined back on (digest, salt), so one payload that many rows share is spread
over ``SALTS`` keys.

``read_warc`` reads archives sequentially, one per task at a time: members
are inflated incrementally in ``CHUNK`` steps, records framed by
Content-Length, and block and payload digests verified; memory does not
depend on the archive's or the record's size. A damaged archive raises.

Results on odd input: a null payload is empty; a null or unprintable URL is
written percent-encoded or left out; equal payloads whose ids are all null
are all responses; rows that repeat the largest id are all responses; an
empty table gives archives without records; other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm.common import stored
from farelake.session import scratch_path

MIN_REVISIT = 1000
SALTS = 64
CHUNK = 1 << 16
ARCHIVE_BYTES = 64 << 20
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = "path string, records long, bytes long"
RECORD = ("path string, member_offset long, record_type string, row_id string, refers_to string, uri string, "
          "payload_bytes long, payload_digest string, verified boolean")


def plan_records(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """(id, uri, body, digest, n, refers_to): refers_to is the response's id for revisits, else null."""
    body = F.coalesce(F.encode(F.col(payload), "UTF-8"), F.lit(b""))
    rows = (pages.select(F.col(key).cast("long").alias("id"), F.col(url).alias("uri"), body.alias("body"))
            .withColumn("digest", F.sha1("body")).withColumn("n", F.octet_length("body").cast("long"))
            .withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")))
    part = rows.where(F.col("n") >= MIN_REVISIT).groupBy("digest", "salt").agg(
        F.max("id").alias("top"), F.count(F.lit(1)).alias("c"))
    groups = (part.groupBy("digest").agg(F.max("top").alias("top"), F.sum("c").alias("c"),
                                         F.collect_list("salt").alias("salts"))
              .where("c > 1").select(F.col("digest").alias("g_digest"), "top", F.explode("salts").alias("g_salt")))
    joined = rows.join(groups, (F.col("digest") == F.col("g_digest")) & (F.col("salt") == F.col("g_salt")), "left")
    refers = F.when(F.col("top").isNotNull() & ~F.col("id").eqNullSafe(F.col("top")), F.col("top"))
    return joined.select("id", "uri", "body", "digest", "n", refers.alias("refers_to"))


def record_id(row_id) -> str:
    """The record id that stands for a row: a name-based UUID."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'row:{row_id}')}>"


def _b32(raw: bytes) -> str:
    return "sha1:" + base64.b32encode(raw).decode()


def make_record(row_id, uri: str | None, body: bytes, digest: str, refers_to) -> bytes:
    """One WARC record, not compressed."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n").encode()
    revisit = refers_to is not None
    block = http if revisit else http + body
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(row_id)}",
            f"WARC-Date: {DATE}", "Content-Type: application/http;msgtype=response",
            f"WARC-Payload-Digest: {_b32(bytes.fromhex(digest))}",
            f"WARC-Block-Digest: {_b32(hashlib.sha1(block).digest())}", f"Content-Length: {len(block)}"]
    if row_id is not None:
        head.append(f"X-Row-ID: {row_id}")
    if uri is not None:
        head.append("WARC-Target-URI: " + urllib.parse.quote(uri, safe="!#$&'()*+,/:;=?@[]~%-._"))
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Row: {refers_to}"]
    return ("\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def _filesystem(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def _int(v):
    return None if pd.isna(v) else int(v)


def _writer(folder: str, limit: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = _filesystem(folder)
        fs.create_dir(base, recursive=True)
        out, n, size, name = None, 0, 0, ""
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                if out is None:
                    name, n, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                member = gzip.compress(make_record(_int(r.id), r.uri, r.body, r.digest, _int(r.refers_to)), 5, mtime=0)
                out.write(member)
                n, size = n + 1, size + len(member)
                if size >= limit:
                    out.close()
                    out = None
                    yield pd.DataFrame({"path": [f"{folder}/{name}"], "records": [n], "bytes": [size]})
        if out is not None:
            out.close()
            yield pd.DataFrame({"path": [f"{folder}/{name}"], "records": [n], "bytes": [size]})
    return run


def write_warc(spark: SparkSession, pages: DataFrame, key: str = "page_id", url: str = "url",
               payload: str = "html", folder: str | None = None, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write one record per row; the stored manifest (path, records, bytes)."""
    folder = folder or scratch_path(spark, "llm", f"warc-{uuid.uuid4().hex[:12]}")
    rows = plan_records(pages, key, url, payload).select(
        F.col("id").cast("string"), "uri", "body", "digest", F.col("refers_to").cast("string"))
    return stored(spark, rows.mapInPandas(_writer(folder, archive_bytes), MANIFEST), "warc-manifest")


class MemberStream:
    """Inflates one gzip member at a time from a byte stream, in small steps."""

    def __init__(self, raw):
        self.raw, self.rest, self.offset = raw, b"", 0
        self.inflate, self.out, self.ended = None, b"", True

    def next_member(self) -> bool:
        """Go to the next member; False at the end of the archive."""
        if not self.rest:
            self.rest = self.raw.read(CHUNK)
        if not self.rest:
            return False
        self.inflate, self.out, self.ended = zlib.decompressobj(31), b"", False
        self.start = self.offset
        return True

    def more(self) -> bool:
        """Inflate a little more; False at the end of the member."""
        while not self.ended:
            data = self.inflate.unconsumed_tail or self.rest or self.raw.read(CHUNK)
            if not data and not self.inflate.eof:
                raise ValueError("archive ends inside a gzip member")
            if data is self.rest:
                self.rest = b""
            got = self.inflate.decompress(data, CHUNK)
            self.offset += len(data) - len(self.inflate.unconsumed_tail) - len(self.inflate.unused_data)
            if self.inflate.eof:
                self.rest, self.ended = self.inflate.unused_data + self.rest, True
            if got:
                self.out += got
                return True
        return False

    def until(self, mark: bytes) -> bytes:
        while mark not in self.out:
            if not self.more():
                raise ValueError("record ends inside its header")
        head, _, self.out = self.out.partition(mark)
        return head

    def take(self, n: int) -> Iterator[bytes]:
        """The next n bytes, piece by piece."""
        while n:
            if not self.out and not self.more():
                raise ValueError("record is shorter than its Content-Length")
            piece, self.out = self.out[:n], self.out[n:]
            n -= len(piece)
            yield piece


def _headers(raw: bytes) -> tuple[str, dict[str, str]]:
    first, *lines = raw.decode("utf-8", "replace").split("\r\n")
    return first, {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def read_records(raw, path: str) -> Iterator[dict]:
    """Records of one archive, read sequentially from the stream ``raw``."""
    stream = MemberStream(raw)
    while stream.next_member():
        first, head = _headers(stream.until(b"\r\n\r\n"))
        if not first.startswith("WARC/1."):
            raise ValueError(f"{path}: no WARC record at {stream.start}")
        left, block, payload, http, got = int(head["content-length"]), hashlib.sha1(), hashlib.sha1(), b"", 0
        body = False
        for piece in stream.take(left):
            block.update(piece)
            if not body:
                http += piece
                if b"\r\n\r\n" not in http:
                    continue
                http, _, piece = http.partition(b"\r\n\r\n")
                body = True
            payload.update(piece)
            got += len(piece)
        if b"".join(stream.take(4)) != b"\r\n\r\n" or stream.out or stream.more():
            raise ValueError(f"{path}: record at {stream.start} does not end its member")
        declared = int(_headers(http)[1].get("content-length", got))
        kind, want = head["warc-type"], head["warc-payload-digest"]
        whole = kind == "revisit" or (got == declared and _b32(payload.digest()) == want)
        yield {"path": path, "member_offset": stream.start, "record_type": kind, "row_id": head.get("x-row-id"),
               "refers_to": head.get("x-refers-to-row"), "uri": head.get("warc-target-uri"),
               "payload_bytes": declared, "payload_digest": base64.b32decode(want[5:]).hex(),
               "verified": whole and _b32(block.digest()) == head["warc-block-digest"]}


def _reader(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = [c.split()[0] for c in RECORD.split(", ")]
    for pdf in batches:
        for path in pdf["path"]:
            fs, at = _filesystem(path)
            with fs.open_input_stream(at, compression=None) as raw:
                some: list[dict] = []
                for rec in read_records(raw, path):
                    some.append(rec)
                    if len(some) == 1000:
                        yield pd.DataFrame(some, columns=columns)
                        some = []
                if some:
                    yield pd.DataFrame(some, columns=columns)


def read_warc(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """One row per record of the archives that ``manifest`` (path, ...) lists."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return manifest.select("path").repartition(n, "path").mapInPandas(_reader, RECORD)


WARC_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS h FROM p),
g AS (SELECT h, max(page_id) AS top FROM d WHERE n >= 1000 GROUP BY h)
SELECT d.page_id, CAST(n AS BIGINT) AS payload_bytes, d.h AS payload_digest,
  CASE WHEN top IS NULL OR top = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN top = page_id THEN NULL ELSE top END AS refers_to, true AS verified
FROM d LEFT JOIN g ON d.h = g.h AND n >= 1000"""

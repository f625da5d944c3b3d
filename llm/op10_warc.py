"""WARC: a deterministic sharded archive of pages, and its reader.

Pages are dealt out in ranges of page_id and sorted; each record is a gzip member of its own, files are closed once their
compressed size reaches FILE_BYTES, and headers and digests are made anew from the payload. Names, record ids, dates and gzip
headers depend on the rows alone, so a repeated task or run writes the same bytes. Files are written under a
temporary name of their own and renamed; a manifest lists those of tasks that succeeded, and the reader keeps no others.
Ranges come from exact counts by key range, which the driver sees one number each of, 65,536 at most.

Of equal payloads (SHA-1 and size) of at least min_bytes, the page with the largest id is the response and the others are revisits
of it. The revisits' targets, a few bytes each, travel to the pages' shards as rows of their own, so pages move once.

Null html is an empty payload, a null url becomes urn:page:<id>. Rows with the response's page_id are responses too.
Rows with a null page_id are responses and come first. Extra columns are ignored. An empty table gives no files and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from llm.common import load, scratch, ship, written
from llm.shards import put, sharded

PAGES_PER_SHARD, FILE_BYTES, MIN_BYTES, DATE = 1024, 8 << 20, 0, "2024-01-01T00:00:00Z"
#: Rows turned into Python values at once.
ROWS = 64
SPACE_ID = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "shard int, part int, file string, records long, bytes long"
RECORDS = "file string, page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
DIGEST = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE_ID, f'{page_id}/{digest}')}>"


def record(page_id, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One WARC record as a gzip member."""
    digest = base32(hashlib.sha1(payload).digest())
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    url = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else f"urn:page:{page_id}"
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit", "WARC-Target-URI": url, "WARC-Date": date, "WARC-Record-ID": record_id(page_id, digest),
        "WARC-Payload-Digest": f"sha1:{digest}", "WARC-Block-Digest": f"sha1:{base32(hashlib.sha1(block).digest())}", "Content-Type": "application/http;msgtype=response",
    }
    if page_id is not None:
        head["X-Page-Id"] = str(page_id)
    if refers_to is not None:
        head |= {"WARC-Profile": PROFILE, "WARC-Refers-To": record_id(refers_to, digest), "X-Refers-To-Page-Id": str(refers_to)}
    head["Content-Length"] = str(len(block))
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()) + "\r\n"
    press = zlib.compressobj(6, zlib.DEFLATED, 31)
    return press.compress(text.encode() + block + b"\r\n\r\n") + press.flush()


def records(data: bytes):
    """Headers, HTTP headers and payload of each record of an archive; damage raises ValueError."""
    view, at = memoryview(data), 0
    while at < len(view):
        member, parts, step = zlib.decompressobj(31), [], 1 << 12
        while not member.eof:
            if at >= len(view):
                raise ValueError("archive is cut off")
            fed = view[at : at + step]  # pieces, so that what is left over of one is small
            parts.append(member.decompress(fed))
            at += len(fed) - len(member.unused_data)
            step = min(2 * step, 1 << 20)
        raw = b"".join(parts)
        head, _, rest = raw.partition(b"\r\n\r\n")
        version, *lines = head.decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError("not a WARC record")
        fields = dict(line.split(": ", 1) for line in lines)
        block = rest[: int(fields["Content-Length"])]
        if base32(hashlib.sha1(block).digest()) != fields["WARC-Block-Digest"].removeprefix("sha1:"):
            raise ValueError("block digest does not match")
        http, _, payload = block.partition(b"\r\n\r\n")
        yield fields, dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:]), payload


def revisits(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Rows (page_id, digest, refers_to): pages whose payload a page with a larger id has too."""
    html = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    keys = pages.filter("page_id IS NOT NULL").select("page_id", F.sha1(html).alias("digest"), F.octet_length(html).alias("size")).filter(F.col("size") >= min_bytes)
    last = keys.groupBy("digest", "size").agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("low")).filter("low < refers_to").drop("low")
    return keys.join(last, ["digest", "size"]).filter("page_id < refers_to").select("page_id", "digest", "refers_to").distinct()


def write_warc(pages: DataFrame, min_bytes: int = MIN_BYTES, pages_per_shard: int = PAGES_PER_SHARD, file_bytes: int = FILE_BYTES, date: str = DATE) -> tuple[str, DataFrame]:
    """Writes all pages; returns the folder and the manifest (MANIFEST)."""
    spark = pages.sparkSession
    ship(spark)
    folder = scratch(spark, "warc")
    pages = pages.select(F.col("page_id").cast("long"), "url", "html")
    none = F.lit(None)
    both = pages.select("page_id", F.lit(1).alias("kind"), "url", F.col("html").cast("binary").alias("html"), none.cast("string").alias("digest"), none.cast("long").alias("refers_to")).unionAll(
        revisits(pages, min_bytes).select("page_id", F.lit(0), none.cast("string"), none.cast("binary"), "digest", "refers_to")
    )

    def run(batches):
        held, size, count, part, shard, page, targets = [], 0, 0, 0, None, None, {}

        def close():
            name = f"part-{shard:08d}-{part:05d}.warc.gz"
            put(folder, name, b"".join(held))
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([part], pa.int32()), pa.array([name]), pa.array([count]), pa.array([size])], ["shard", "part", "file", "records", "bytes"])

        for b in batches:
            for page_id, kind, url, html, digest, refers_to, own in (row for lo in range(0, len(b), ROWS) for row in zip(*(c.to_pylist() for c in b.slice(lo, ROWS).columns), strict=True)):
                if own != shard:
                    if held:
                        yield close()
                    held, size, count, part, shard = [], 0, 0, 0, own
                if page_id != page:
                    page, targets = page_id, {}
                if kind == 0:
                    targets[digest] = refers_to
                    continue
                payload = html or b""
                target = targets.get(hashlib.sha1(payload).hexdigest()) if targets and len(payload) >= min_bytes else None
                held.append(record(page_id, url, payload, target, date))
                size, count = size + len(held[-1]), count + 1
                if size >= file_bytes:
                    yield close()
                    held, size, count, part = [], 0, 0, part + 1
        if held:
            yield close()

    rows = sharded(both, "page_id", pages_per_shard, ["kind", "url", "html"], of=pages)
    return folder, written(spark, rows.mapInArrow(run, MANIFEST), "manifest")


def read_warc(spark: SparkSession, folder: str, manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """The records (columns of RECORDS but file) of the archives that the manifest lists. A revisit's payload is null."""
    ship(spark)
    columns = [f.split()[0] for f in RECORDS.split(", ")]
    if not manifest.take(1):
        return spark.createDataFrame([], RECORDS).drop("file")

    def run(batches):
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                rows = []
                for fields, http, payload in records(content.as_py()):
                    digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
                    if kind == "response" and digest != base32(hashlib.sha1(payload).digest()):
                        raise ValueError("payload digest does not match")
                    ids = [int(fields[k]) if k in fields else None for k in ("X-Page-Id", "X-Refers-To-Page-Id")]
                    rows.append((path.rsplit("/", 1)[-1], ids[0], fields["WARC-Target-URI"], int(http["Content-Length"]), digest, kind, ids[1], payload if payloads and kind == "response" else None))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], columns)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder).select("path", "content")
    return files.mapInArrow(run, RECORDS).join(manifest.select("file"), "file", "left_semi").drop("file")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_warc(spark, *write_warc(load(spark, sf_dir, "pages")), payloads=False).select(*DIGEST)


_CHARS = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((('0x' || substr(h, {5 * g + 1}, 5))::BIGINT >> {s}) & 31 AS BIGINT) + 1, 1)" for g in range(8) for s in (15, 10, 5, 0))
ORACLE_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
k AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS h, max(page_id) OVER (PARTITION BY html) AS last FROM p)
SELECT page_id, payload_bytes, {_CHARS} AS payload_digest, CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id < last THEN last END AS refers_to FROM k
"""

"""WARC archives: index first, then coalesced range reads.

write_warc() gives each task its own archive of gzip members, one for each record, and
returns the index: file, offset, length, URL and digest of each record. read_warc() takes
index rows, sorts them by file and offset, merges neighbours into ranges of bounded size
and gap, reads each range once and parses the records in it.

Of records with equal payloads of at least min_revisit_bytes, the one with the largest id
is written as a response, the others as revisits that refer to it (WARC/1.1, profile
identical-payload-digest). Digests are SHA-1 in base32, of the payload as served.

Edge cases: null html is an empty payload; null URLs are written as about:blank; a null id
takes part in no comparison and is a response. Rows that share id and payload are each
written; those of the largest id are all responses. An empty table gives no archive and an empty index.
Only the three columns named are read, so other columns can't clash.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ByteWriter, cut, read_range, shared_dir, small, tidy

DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: An archive is closed when it is this large.
ARCHIVE_BYTES = 256 << 20
#: Neighbouring records are read together over gaps up to this, into ranges up to that size.
GAP_BYTES, RANGE_BYTES = 64 << 10, 8 << 20
#: Bytes of archives that a task reads, about; fewer if cores would be idle.
TASK_BYTES = 64 << 20
_INDEX = "page_id long, url string, path string, offset long, length long, payload_digest string, record_type string"
_READ = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"
_INDEX_SCHEMA = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string())])


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _one_line(url: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "about:blank")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record; the block is an HTTP response, without its payload in a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}", f"WARC-Target-URI: {_one_line(url)}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join([*head, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """The record in data (already uncompressed); raises if its payload lacks the digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = {k.lower(): v for k, v in (x.split(": ", 1) for x in lines[1:])}
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?i)\r\ncontent-length: *(\d+)", http)[1])
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    kind = fields["warc-type"]
    if kind == "response" and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError(f"record {fields['warc-record-id']} doesn't hold the payload that it names")
    number = lambda x: int(m[1]) if (m := re.fullmatch(r"<urn:page:(-?\d+)>", x or "")) else None
    return {"page_id": number(fields["warc-record-id"]), "url": fields["warc-target-uri"], "record_type": kind, "payload_bytes": size, "payload_digest": digest, "refers_to": number(fields.get("warc-refers-to")), "payload": payload if kind == "response" else None}


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                if out is None or out.size >= ARCHIVE_BYTES:
                    if out:
                        out.close()
                    out = ByteWriter(folder, ".warc.gz")
                payload = (r["html"] or "").encode()
                digest = base32_sha1(payload)
                z = zlib.compressobj(6, zlib.DEFLATED, 31)
                member = z.compress(record(r["page_id"], r["url"], payload, digest, r["refers_to"])) + z.flush()
                rows.append({"page_id": r["page_id"], "url": r["url"], "path": out.uri, "offset": out.write(member), "length": len(member), "payload_digest": digest, "record_type": "response" if r["refers_to"] is None else "revisit"})
            yield pa.RecordBatch.from_pylist(rows, schema=_INDEX_SCHEMA)
        if out:
            out.close()

    return run


def write_warc(pages: DataFrame, folder: str | None = None, min_revisit_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Writes the archives now and returns their index (a written table):
    page_id, url, path, offset, length, payload_digest, record_type."""
    spark = pages.sparkSession
    own = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"), F.col(f"`{html_col}`").cast("string").alias("html"))
    body = F.coalesce("html", F.lit(""))
    own = own.withColumn("key", F.sha2(body, 256))
    # only payloads that occur twice travel to the join; the count is combined before its shuffle
    first = own.filter(F.octet_length(body) >= min_revisit_bytes).groupBy(F.col("key").alias("copy_key")).agg(F.max("page_id").alias("largest"), F.count("page_id").alias("n"))
    copies = cut(first.filter("n > 1").select("copy_key", "largest"), "warc-copies")
    marked = own.join(small(copies), F.col("key") == F.col("copy_key"), "left").select("page_id", "url", "html", F.when(F.col("page_id") < F.col("largest"), F.col("largest")).alias("refers_to"))
    return cut(marked.mapInArrow(tidy(_write(folder or shared_dir(spark, "warc"))), _INDEX), "warc-index")


def ranges(selected: DataFrame, gap: int = GAP_BYTES, size: int = RANGE_BYTES) -> DataFrame:
    """Index rows, sorted by place, as one row for each read: path, first, length and the
    records' offsets and lengths. Rows are cut by place into cells of `size` bytes, and
    within a cell where the gap to the next record is larger than `gap`."""
    from pyspark.sql import Window

    cell = F.floor(F.col("offset") / size)
    w = Window.partitionBy("path", "cell").orderBy("offset")
    gone = F.col("offset") - F.lag(F.col("offset") + F.col("length")).over(w) > gap
    placed = selected.select("path", "offset", "length", cell.alias("cell")).withColumn("run", F.sum(F.coalesce(gone, F.lit(False)).cast("int")).over(w))
    return placed.groupBy("path", "cell", "run").agg(F.min("offset").alias("first"), (F.max(F.col("offset") + F.col("length")) - F.min("offset")).alias("total"), F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("records"))


def _read(keep_payload: bool):
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                raw, rows = read_range(r["path"], r["first"], r["total"]), []
                for x in r["records"]:
                    at = x["offset"] - r["first"]
                    got = parse(zlib.decompress(raw[at : at + x["length"]], 31))
                    rows.append(got if keep_payload else got | {"payload": None})
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return run


def read_warc(selected: DataFrame, keep_payload: bool = True) -> DataFrame:
    """The records that the given index rows name: page_id, url, record_type, payload_bytes,
    payload_digest, refers_to, payload (null for revisits, or if not kept)."""
    reads = cut(ranges(selected).select("path", "first", "total", "records"), "warc-ranges")
    n, total = reads.agg(F.count(F.lit(1)), F.coalesce(F.sum("total"), F.lit(0))).first()
    # the index is small, so its own partitions would be few: reads are dealt out by the bytes they ask for
    parts = max(-(-total // TASK_BYTES), min(n, 2 * selected.sparkSession.sparkContext.defaultParallelism), 1)
    return reads.repartition(parts).mapInArrow(tidy(_read(keep_payload)), _READ)

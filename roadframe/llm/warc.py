"""Deterministic sharded WARC writer and its reader.

Records are sorted by key ranges; each task streams its range into gzip files
(one member for each record), begins a new file when the compressed size
reaches ``roll_bytes``, and commits each file by a rename. Headers, record ids
and digests are made anew from key, target and payload alone, so a repeated
task or run writes the same bytes. ``manifest.json`` names the committed files
with their key ranges, sizes and digests; it is written last, also by a rename,
and the reader opens only files that it names.

Of records with equal payloads of at least ``min_revisit`` bytes the one of
smallest key is a response and the others are revisits without payload. Only
payload digests that occur twice or more are joined back, from a written table
whose size tells Spark whether to broadcast it.

Defined cases: a null payload is empty; a null target becomes ``urn:record:``
and the key; null keys are sorted first, revisit an equal payload that has a
key, and are all responses if there is none; rows that repeat key and payload
revisit the first of them; an empty table gives a manifest without files; other
columns are not written.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadframe.llm import common, files
from roadframe.llm.registry import register
from roadframe.session import read_table, scratch_path

ROLL_BYTES = 64 << 20
MIN_REVISIT = 100
DATE = "1970-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "file string, first_key long, last_key long, records long, bytes long, sha256 string"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, file string, offset long"


def record_id(*parts: object) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(repr(parts).encode()).digest()[:16], version=5)}>"


def gzip_member(data: bytes) -> bytes:
    c = zlib.compressobj(6, zlib.DEFLATED, 31)  # zlib's gzip header has no time
    return c.compress(data) + c.flush()


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [*headers, ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines).encode() + b"\r\n" + block + b"\r\n\r\n"


def page_record(key: int | None, target: str | None, payload: bytes | None, size: int, digest: str, refers_to: int | None, repeat: int, date: str) -> bytes:
    """payload None: a revisit of the record of key ``refers_to``."""
    kind = "response" if payload is not None else "revisit"
    uri = quote(target, safe="!#$%&'()*+,/:;=?@[]~-._") if target else f"urn:record:{'' if key is None else key}"
    headers = [("WARC-Type", kind), ("WARC-Record-ID", record_id(key, digest, kind, repeat)), ("WARC-Date", date), ("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha256:{digest}")]
    if key is not None:
        headers.append(("WARC-X-Key", str(key)))
    if payload is None:
        headers += [("WARC-Profile", REVISIT), ("WARC-Refers-To", record_id(refers_to, digest, "response", 0))]
        headers += [("WARC-X-Refers-To-Key", str(refers_to))] if refers_to is not None else []
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    return record([*headers, ("Content-Type", "application/http; msgtype=response")], http + (payload or b""))


def write(df: DataFrame, folder: str, key: str = "page_id", target: str = "url", payload: str = "html", roll_bytes: int = ROLL_BYTES, min_revisit: int = MIN_REVISIT, date: str = DATE) -> dict:
    """Write every row of ``df`` as a record; returns the manifest."""
    common.bounded_batches(df.sparkSession)
    files.make_folder(folder)
    body = F.coalesce(F.col(payload).cast("string"), F.lit(""))
    rows = df.select(F.col(key).cast("long").alias("key"), F.col(target).cast("string").alias("target"), body.alias("payload"))
    rows = rows.withColumns({"size": F.octet_length("payload").cast("long"), "digest": F.sha2("payload", 256)})
    large = F.col("size") >= min_revisit
    known = rows.where(large).groupBy("digest").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("digest").alias("known"), "first")
    known = common.stage(known, "repeated-payloads")  # of known size: broadcast if small, so that payloads are shuffled once
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("key"))
    rows = rows.join(known, (F.col("digest") == F.col("known")) & large, "left")
    rows = rows.select("key", "target", F.when(~revisit, F.col("payload")).alias("payload"), "size", "digest", F.when(revisit, F.col("first")).alias("first"))
    order = [F.col("key").asc_nulls_first(), "digest", F.col("target").asc_nulls_first()]
    rows = rows.repartitionByRange(*order[:2]).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, done, hashed, first, last, n, rolled = None, [], None, None, None, 0, 0
        before, repeat = None, 0

        def close() -> None:
            out.commit()
            done.append((out.final.rpartition("/")[2], first, last, n, out.size, hashed.hexdigest()))

        for b in batches:
            for k, t, p, size, digest, f, part in zip(*(c.to_pylist() for c in b.columns), strict=True):
                repeat = repeat + 1 if before == (k, digest) else 0
                before = (k, digest)
                if p is not None and repeat and size >= min_revisit and k is not None:
                    p, f = None, k
                if out is None:
                    name = f"part-{part:06d}-{rolled:05d}.warc.gz"
                    out, hashed, first, n = files.Committed(folder, name), hashlib.sha256(), k, 0
                    info = record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(name)), ("WARC-Date", date), ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
                    out.write(data := gzip_member(info))
                    hashed.update(data)
                out.write(data := gzip_member(page_record(k, t, p.encode() if p is not None else None, size, digest, f, repeat, date)))
                hashed.update(data)
                last, n = k, n + 1
                if out.size >= roll_bytes:
                    close()
                    out, rolled = None, rolled + 1
        if out is not None:
            close()
        if done:
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), kinds, strict=True)], names=[c.split()[0] for c in MANIFEST.split(", ")])

    found = sorted((r.asDict() for r in rows.mapInArrow(run, MANIFEST).collect()), key=lambda r: r["file"])  # one row for each file
    manifest = {"files": found, "records": sum(r["records"] for r in found)}
    files.write_manifest(folder, manifest)
    return manifest


def members(stream, chunk: int = 1 << 20) -> Iterator[tuple[int, bytes]]:
    """(offset, content) of each gzip member."""
    held, at = stream.read(chunk), 0
    while held:
        d, parts, used = zlib.decompressobj(31), [], 0
        while not d.eof:
            parts.append(d.decompress(held))
            used += len(held) - len(d.unused_data)
            held = d.unused_data
            if not d.eof and not (held := stream.read(chunk)):
                raise ValueError("a member is cut off")
        yield at, b"".join(parts)
        at += used
        held = held or stream.read(chunk)


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of a record, its length and block digest checked."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(headers["Content-Length"])]
    if lines[0] != "WARC/1.1" or rest[len(block) :] != b"\r\n\r\n" or headers["WARC-Block-Digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
        raise ValueError("a record is damaged")
    return headers, block


def read(spark: SparkSession, folder: str, with_payload: bool = False) -> DataFrame:
    """One row for each page record of the files that the manifest names; payload: null for revisits."""
    manifest = files.read_manifest(folder)
    schema = RECORDS + ", payload binary" * with_payload
    names = spark.createDataFrame([(r["file"],) for r in manifest["files"]], "file string")
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*rows, strict=True), fields, strict=True)], names=[f for f, _ in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = files.filesystem(folder)
        for b in batches:
            for name in b.column(0).to_pylist():
                rows: list[tuple] = []
                with store.open_input_stream(f"{root}/{name}", compression=None) as f:
                    for at, data in members(f):
                        headers, block = parse(data)
                        if headers["WARC-Type"] == "warcinfo":
                            continue
                        http, _, payload = block.partition(b"\r\n\r\n")
                        size, digest = int(re.search(rb"Content-Length: (\d+)", http)[1]), headers["WARC-Payload-Digest"].removeprefix("sha256:")
                        whole = headers["WARC-Type"] == "response"
                        if whole and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
                            raise ValueError(f"{name}, {at}: the payload is damaged")
                        key, to = (int(headers[h]) if h in headers else None for h in ("WARC-X-Key", "WARC-X-Refers-To-Key"))
                        rows.append((key, headers["WARC-Target-URI"], size, digest, headers["WARC-Type"], to, name, at, *([payload if whole else None] if with_payload else [])))
                        if len(rows) >= common.BATCH_ROWS:
                            yield batch(rows)
                            rows = []
                if rows:
                    yield batch(rows)

    return names.repartition(max(1, len(manifest["files"]))).mapInArrow(run, schema)


ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages),
f AS (SELECT html, min(page_id) AS first FROM p WHERE n >= {MIN_REVISIT} GROUP BY html)
SELECT p.page_id, CAST(p.n AS BIGINT) AS payload_bytes, sha256(p.html) AS payload_digest,
       CASE WHEN f.first <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first <> p.page_id THEN f.first END AS refers_to
FROM p LEFT JOIN f ON f.html = p.html AND p.n >= {MIN_REVISIT}
"""


@register("op6_warc", ORACLE)
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive all pages, then read the archives back."""
    folder = scratch_path(spark, "warc")
    write(read_table(spark, sf_dir, "pages"), folder)
    return read(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")

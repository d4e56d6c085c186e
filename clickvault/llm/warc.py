"""WARC archives: a deterministic sharded writer and its reader.

Records are one gzip member each. Their order is by ``page_id`` (ties: payload
digest, address); a record belongs to file ``floor(compressed bytes before it
/ roll_bytes)`` of that order, so the files are the same whatever the
partitions were, and none is longer than ``roll_bytes`` and one record.

Of records with equal payloads of at least ``least`` bytes the one with the
largest ``page_id`` is the response and the others revisit it. Only digests
and ids are grouped (map-side combined), never payloads.

Files are written under a temporary name by Spark's own writer, so a lost or
repeated task leaves nothing behind, renamed when all are complete, and
published by the manifest's rename.

Each record is followed by an empty gzip member (the writer's separator);
readers see it as no bytes.

Null html: an empty payload. Null url: ``urn:x-none``; control characters,
spaces and code points from U+0080 in an address are percent-encoded. Null
page ids come first and are never the response of another record. Rows with
the same payload and the same largest id are responses each; repeats of a
whole row lie in one file. An empty table
gives a manifest without files.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickvault.llm.common import (batched, columns_of, commit_files, fresh_path, list_files, materialize, pick,
                                   read_blobs, write_blobs)
from clickvault.plans.materialize import small_side

EMPTY_MEMBER = bytes.fromhex("1f8b08000000000000ff03000000000000000000").decode("latin-1")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SIZE = pa.schema([("page_id", pa.int64()), ("digest", pa.string()), ("uri", pa.string()), ("size", pa.int64())])
_RECORD = pa.schema([("file_no", pa.int32()), ("page_id", pa.int64()), ("digest", pa.string()), ("uri", pa.string()), ("record", pa.binary())])
READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, uri string, payload binary"
_READ = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                   ("record_type", pa.string()), ("refers_to", pa.int64()), ("uri", pa.string()), ("payload", pa.binary())])


def address(url: str | None) -> str:
    return quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url else "urn:x-none"


def record_id(page_id: int | None) -> str:
    return f"<urn:x-page:{'null' if page_id is None else page_id}>"


def sha1_label(hex_digest: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(hex_digest)).decode()


def build(page_id: int | None, uri: str, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One uncompressed record; every header comes from the row."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id)}",
            f"WARC-Date: {date}", f"WARC-Target-URI: {uri}", "Content-Type: application/http;msgtype=response",
            f"WARC-Payload-Digest: {sha1_label(digest)}", f"WARC-Block-Digest: {sha1_label(hashlib.sha1(block).hexdigest())}"]
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def with_targets(pages: DataFrame, least: int = 1000) -> DataFrame:
    """``page_id url html digest refers_to``: the response that each record revisits, if any."""
    rows = pick(pages, "page_id", "url", "html").withColumn("html", F.coalesce("html", F.lit("")))
    rows = rows.withColumns({"digest": F.sha1(F.encode("html", "UTF-8")), "n": F.octet_length("html")})
    groups = (rows.filter(F.col("n") >= least).groupBy("digest", "n")
              .agg(F.max("page_id").alias("target"), F.count(F.lit(1)).alias("copies"))
              .filter("copies > 1 AND target IS NOT NULL").drop("copies"))
    target, _ = small_side(groups, "warc-targets")
    return rows.join(target, ["digest", "n"], "left").select(
        "page_id", "url", "html", "digest",
        F.when(F.col("target").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("target")), F.col("target")).alias("refers_to"))


def _member(row: tuple, level: int, date: str) -> tuple[str, bytes]:
    """Address and gzip member of a row (page_id, url, html, digest, refers_to)."""
    page, url, html, digest, target = row
    uri, z = address(url), zlib.compressobj(level, zlib.DEFLATED, 31)
    return uri, z.compress(build(page, uri, html.encode(), digest, target, date)) + z.flush()


def _key(page: int | None, digest: str, uri: str) -> tuple:
    """Records are ordered by this, as Spark orders the three columns."""
    return page is not None, page or 0, digest, uri


def _rows(batch: pa.RecordBatch):
    cols = batch.to_pydict()
    return zip(*(cols[c] for c in ("page_id", "url", "html", "digest", "refers_to")), strict=True)


def file_starts(sizes: DataFrame, roll_bytes: int) -> list[tuple]:
    """The first key of each file, and the file's records and bytes.

    ``sizes`` (``page_id digest uri size``) is sorted by ranges; each range's
    running sum starts at the sum of the ranges before it.
    """
    def running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = 0
        for batch in batches:
            size = batch.column("size").to_numpy(zero_copy_only=False).astype("int64")
            yield batch.append_column("at", pa.array(before + np.cumsum(size) - size, pa.int64()))
            before += int(size.sum())

    order = ["page_id", "digest", "uri"]
    total = sizes.agg(F.sum("size")).first()[0] or 0
    ranged = (sizes.repartitionByRange(max(1, -(-total // roll_bytes)), *order).sortWithinPartitions(*order)
              .withColumn("part", F.spark_partition_id()))
    ranged = materialize(ranged.mapInArrow(running, "page_id long, digest string, uri string, size long, part int, at long"), "warc-ranged")
    # one row a range; the ranges are as many as the files
    sums = ranged.groupBy("part").agg(F.sum("size").alias("bytes"))
    first = sums.select("part", (F.sum("bytes").over(Window.orderBy("part")) - F.col("bytes")).alias("first"))
    placed = ranged.join(first, "part").withColumn("at", F.col("first") + F.col("at"))
    # repeats of a row have one key, and stay together
    keys = placed.groupBy(*order).agg(F.min("at").alias("at"), F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"))
    files = keys.groupBy(F.floor(F.col("at") / roll_bytes).alias("file")).agg(
        F.min(F.struct("at", *order)).alias("k"), F.sum("n").alias("records"), F.sum("size").alias("bytes"), F.max("page_id").alias("last"))
    return [(_key(*r["k"][1:]), r["k"]["page_id"], r["last"], r["records"], r["bytes"]) for r in files.orderBy("file").collect()]


def write_warc(pages: DataFrame, out: str, roll_bytes: int = 32 << 20, least: int = 1000, level: int = 6,
               date: str = "2000-01-01T00:00:00Z") -> list[dict]:
    """Write ``pages`` (``page_id url html``) as ``out/pages-NNNNNNNN.warc.gz``
    and ``out/manifest.json``; returns the manifest (one entry a file).

    Records are made twice: once for their sizes, which place the files'
    borders, and once to be written, so only finished members are shuffled,
    and once.
    """
    spark = pages.sparkSession
    rows = with_targets(pages, least)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sized():
            for batch in batches:
                for row in _rows(batch):
                    uri, member = _member(row, level, date)
                    yield {"page_id": row[0], "digest": row[3], "uri": uri, "size": len(member) + len(EMPTY_MEMBER)}

        yield from batched(sized(), _SIZE)

    starts = file_starts(materialize(rows.mapInArrow(measure, "page_id long, digest string, uri string, size long"), "warc-sizes"), roll_bytes)
    borders = [s[0] for s in starts]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records():
            for batch in batches:
                for row in _rows(batch):
                    uri, member = _member(row, level, date)
                    key = _key(row[0], row[3], uri)
                    yield {"file_no": bisect.bisect_right(borders, key) - 1, "page_id": row[0], "digest": row[3], "uri": uri, "record": member}

        yield from batched(records(), _RECORD, weigh="record")

    records = rows.mapInArrow(encode, "file_no int, page_id long, digest string, uri string, record binary")
    base = out.rstrip("/")
    temp = f"{base}/_temporary-{fresh_path(spark, 'w').rsplit('-', 1)[1]}"
    write_blobs(records.repartition("file_no").sortWithinPartitions("file_no", "page_id", "digest", "uri"), temp, "record", EMPTY_MEMBER, by="file_no")
    files = {int(p.rsplit("file_no=", 1)[1].split("/")[0]): (p, n) for p, n in list_files(spark, temp)}
    if [files[i][1] for i in sorted(files)] != [s[4] for s in starts]:
        raise OSError(f"the files under {temp} are not as long as their records")
    manifest = [{"file": f"pages-{i:08d}.warc.gz", "first_page_id": lo, "last_page_id": hi, "records": n, "bytes": size}
                for i, (_, lo, hi, n, size) in enumerate(starts)]
    commit_files(spark, [(files[i][0], f"{base}/{m['file']}") for i, m in enumerate(manifest)], f"{base}/manifest.json", manifest)
    return manifest


def members(data: bytes, step: int = 1 << 14) -> Iterator[bytes]:
    """The decompressed gzip members of a file, one at a time, empty ones left out."""
    at, n, view = 0, len(data), memoryview(data)
    while at < n:
        z, parts = zlib.decompressobj(31), []
        while not z.eof:
            if at >= n:
                raise ValueError("the last gzip member is cut off")
            chunk = view[at:at + step]
            parts.append(z.decompress(chunk))
            at += len(chunk) - len(z.unused_data)
        if raw := b"".join(parts):
            yield raw


def _page(urn: str) -> int | None:
    number = urn.rsplit(":", 1)[1].rstrip(">")
    return None if number == "null" else int(number)


def parse(raw: bytes) -> dict:
    """One record, its digests and lengths checked."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    n = int(fields["Content-Length"])
    block = rest[:n]
    if lines[0] != "WARC/1.1" or len(block) != n or rest[n:] != b"\r\n\r\n":
        raise ValueError(f"broken record {fields.get('WARC-Record-ID')}")
    if fields["WARC-Block-Digest"] != sha1_label(hashlib.sha1(block).hexdigest()):
        raise ValueError(f"block digest of {fields['WARC-Record-ID']} differs")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(x.split(b": ", 1) for x in http.split(b"\r\n")[1:])[b"Content-Length"])
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"]
    if kind == "response" and (len(payload) != size or digest != sha1_label(hashlib.sha1(payload).hexdigest())):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} differs")
    return {"page_id": _page(fields["WARC-Record-ID"]), "payload_bytes": size, "record_type": kind,
            "payload_digest": base64.b32decode(digest.removeprefix("sha1:")).hex(), "uri": fields["WARC-Target-URI"],
            "refers_to": _page(fields["WARC-Refers-To"]) if kind == "revisit" else None,
            "payload": payload if kind == "response" else None}


def read_warc(spark: SparkSession, out: str) -> DataFrame:
    """One row per record of the archives under ``out``, in no order; a file is one task's work."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for (data,) in zip(*columns_of(batch, "content"), strict=True):
                yield from batched(map(parse, members(data)), _READ, weigh="payload")

    return read_blobs(spark, out, "*.warc.gz").select("content").mapInArrow(run, READ)

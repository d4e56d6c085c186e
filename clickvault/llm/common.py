"""Helpers shared by the operators: text rules, staged tables, raw files.

Word rules (fixed by the contracts):

* ``SPACE_WORDS``: runs of anything but space and U+0009..U+000D. On UTF-8
  bytes this is exactly ``bytes.split()``.
* ``ALNUM_WORDS``: runs of 0-9, a-z and every code point from U+0080, after
  A-Z are lower-cased (no other letter is).

Files: executors write raw bytes through Spark's own text writer
(:func:`write_blobs`), so any Hadoop file system works, a lost task's output
never shows (commit protocol) and no local folder is involved.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickvault.plans.materialize import materialize, parse_bytes
from clickvault.session import fresh_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BATCH_CONF, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20
NOT_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NOT_SPACE = r"[\x20\x09-\x0D]+"

__all__ = ["UPPER", "LOWER", "alnum_words", "batched", "commit_files", "fresh_path", "list_files",
           "map_texts", "materialize", "pick", "read_blobs", "write_blobs"]


def pick(df: DataFrame, *cols: str) -> DataFrame:
    """The named columns alone: extra input columns, whatever they are called,
    never meet the operator's own names."""
    return df.select(*[F.col(f"`{c}`") for c in cols])


def lower_ascii(col: Column) -> Column:
    return F.translate(col, UPPER, LOWER)


def alnum_words(text: Column) -> Column:
    """``ALNUM_WORDS`` of a text as an array (null text: no words)."""
    parts = F.split(lower_ascii(F.coalesce(text, F.lit(""))), NOT_ALNUM, -1)
    return F.filter(parts, lambda w: w != "")


def with_words(df: DataFrame, text: str, out: str) -> DataFrame:
    """Replaces ``text`` by its ``ALNUM_WORDS``, computed once: a generator of
    one row keeps the optimizer from writing the split into what is built on
    it, where a lambda would run it again for every element."""
    kept = [c for c in df.columns if c != text]
    return df.select(*kept, F.explode_outer(F.array(alnum_words(F.col(text)))).alias(out))


def map_texts(docs: DataFrame, run, schema) -> DataFrame:
    """``mapInArrow`` over rows with texts: batches are bounded by ``BATCH_BYTES``, not by
    their number of rows alone, so what a task holds beside the heap does not follow the texts' length."""
    spark = docs.sparkSession
    if parse_bytes(spark.conf.get(BATCH_CONF, "64m")) > BATCH_BYTES:  # 64m: what Spark takes when it is not set
        spark.conf.set(BATCH_CONF, str(BATCH_BYTES))
    return docs.mapInArrow(run, schema)


def batched(rows: Iterator[dict], schema: pa.Schema, most_rows: int = 4096,
            most_bytes: int = 16 << 20, weigh: str | None = None) -> Iterator[pa.RecordBatch]:
    """Arrow batches of bounded rows and bytes (``weigh``: the column that holds the bytes)."""
    held: list[dict] = []
    size = 0
    for row in rows:
        held.append(row)
        size += len(row[weigh]) if weigh and row[weigh] is not None else 0
        if len(held) >= most_rows or size >= most_bytes:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def columns_of(batch: pa.RecordBatch, *names: str) -> list[list]:
    """Python lists of the columns; strings come as their UTF-8 bytes."""
    out = []
    for name in names:
        col = batch.column(batch.schema.get_field_index(name))
        if pa.types.is_string(col.type) or pa.types.is_large_string(col.type):
            col = col.cast(pa.binary() if pa.types.is_string(col.type) else pa.large_binary())
        out.append(col.to_pylist())
    return out


# ---- raw files -------------------------------------------------------------

def write_blobs(df: DataFrame, path: str, blob: str, trailer: str, by: str | None = None) -> None:
    """Write the binary column ``blob`` row after row, each followed by the
    bytes of ``trailer`` (Latin-1 text, part of the file format).

    One file per task, or with ``by`` (already sorted inside the partitions)
    one folder ``by=value`` per value.
    """
    out = df.select(F.col(blob).cast("string").alias("value"), *([by] if by else []))
    writer = out.write.option("encoding", "ISO-8859-1").option("lineSep", trailer)
    (writer.partitionBy(by) if by else writer).text(path)


def read_blobs(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """One row per file: ``path``, ``length``, ``content``. The writers roll
    files at a size far below the reader's 2 GB per file."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
            .option("recursiveFileLookup", "true").load(path).select("path", "length", "content"))


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def list_files(spark: SparkSession, path: str, skip: str = "_.") -> list[tuple[str, int]]:
    """(path, length) of the files below ``path``, sorted; names that start with ``_`` or ``.`` left out."""
    jvm, fs = _fs(spark, path)
    it, found = fs.listFiles(jvm.org.apache.hadoop.fs.Path(path), True), []
    while it.hasNext():
        s = it.next()
        if s.getPath().getName()[0] not in skip:
            found.append((s.getPath().toString(), s.getLen()))
    return sorted(found)


def commit_files(spark: SparkSession, moves: list[tuple[str, str]], manifest_path: str, manifest: list[dict]) -> None:
    """Rename finished files to their final names, then publish the manifest
    by one rename: a reader that sees the manifest sees every file.

    The driver handles names only (one metadata call per rolled file)."""
    jvm, fs = _fs(spark, manifest_path)
    P = jvm.org.apache.hadoop.fs.Path
    for src, dst in moves:
        fs.mkdirs(P(dst).getParent())
        if not fs.rename(P(src), P(dst)):
            raise OSError(f"could not rename {src} to {dst}")
    fs.mkdirs(P(manifest_path).getParent())
    tmp = P(manifest_path + ".tmp")
    out = fs.create(tmp, True)
    out.write(bytearray("".join(json.dumps(m, sort_keys=True) + "\n" for m in manifest).encode()))
    out.close()
    if not fs.rename(tmp, P(manifest_path)):
        raise OSError(f"could not publish {manifest_path}")

"""Written intermediate tables and size-checked broadcasts.

A join side that is usually small is cached and measured (rows and payload
bytes) in one job; it is broadcast only when the measured size is within
``spark.sql.autoBroadcastJoinThreshold``. Beyond that it is written to the
shared staging folder (``spark.checkpoint.dir``), which cuts lineage, and
the caller's join stays a shuffle join (AQE splits skewed partitions).
Large intermediates that are reused go through ``materialize`` (written and
read back) or a cache whose lineage starts at a written table.
"""

from __future__ import annotations

import re
import threading

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickvault.session import fresh_path

_DEFAULT_LIMIT = 10 * 1024 * 1024
_CACHED: list[DataFrame] = []
_LOCK = threading.Lock()
# per-row overhead of a broadcast hash relation entry (row header + hash slot)
_ROW_OVERHEAD = 32
_UNITS = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20,
          "g": 1 << 30, "gb": 1 << 30, "t": 1 << 40, "tb": 1 << 40}


def _row_bytes(df: DataFrame):
    parts = [F.coalesce(F.octet_length(F.col(f.name).cast("string")), F.lit(0)) + F.lit(8)
             for f in df.schema.fields]
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total + F.lit(_ROW_OVERHEAD)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the staging folder and read it back."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def parse_bytes(text: str) -> int:
    """Spark byte-size strings: ``10485760``, ``10485760b``, ``20MB``, ``1g``."""
    m = re.fullmatch(r"\s*(-?\d+)\s*([a-zA-Z]*)\s*", str(text))
    if not m:
        raise ValueError(f"not a byte size: {text!r}")
    unit = m.group(2).lower() or "b"
    if unit not in _UNITS:
        raise ValueError(f"unknown byte unit in {text!r}")
    return int(m.group(1)) * _UNITS[unit]


def broadcast_limit(spark) -> int:
    """The session's broadcast threshold in bytes (0 when broadcasts are off)."""
    raw = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", str(_DEFAULT_LIMIT))
    try:
        value = parse_bytes(raw)
    except ValueError:
        value = _DEFAULT_LIMIT
    return value if value > 0 else 0


def measure(df: DataFrame) -> tuple[int, int]:
    """Row count and payload bytes of ``df`` (one job)."""
    got = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(_row_bytes(df)).alias("bytes")).first()
    return int(got["rows"] or 0), int(got["bytes"] or 0)


def measured_side(df: DataFrame, name: str, limit: int | None = None) -> tuple[DataFrame, int, bool]:
    """Prepare a (usually) small join side: the frame to join, its rows, and
    whether it is broadcast.

    The side is cached (memory, spilling to disk) and measured in one job.
    When it fits the broadcast limit it is hinted for broadcast — the
    broadcast reads the cache, and a lost executor only recomputes its
    partitions from lineage. When it does not fit, it is written to the
    staging folder instead (lineage cut) and joined with a shuffle join.
    """
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    with _LOCK:
        _CACHED.append(cached)
    rows, size = measure(cached)
    limit = broadcast_limit(df.sparkSession) if limit is None else limit
    if limit and size <= limit:
        return F.broadcast(cached), rows, True
    written = materialize(cached, name)
    cached.unpersist()
    return written, rows, False


def small_side(df: DataFrame, name: str, limit: int | None = None) -> tuple[DataFrame, int]:
    """``measured_side`` without the last part."""
    return measured_side(df, name, limit)[:2]


def release_small_sides() -> int:
    """Unpersist the small sides cached so far (call when the frames built
    on them have been written). Returns how many were released."""
    with _LOCK:
        items, _CACHED[:] = list(_CACHED), []
    for df in items:
        df.unpersist()
    return len(items)

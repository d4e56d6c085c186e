"""Readers for the driver's parquet tables and for our own Silver/Gold output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickvault.session import ensure_session
from clickvault.sources.fixture import clickstream


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze click-stream (with ``source_row_number``) derived from the test tables."""
    ensure_session(spark)
    return clickstream(table(spark, sf_dir, "events"), table(spark, sf_dir, "part"))


def scan_silver(spark: SparkSession, path: str) -> DataFrame:
    """Silver is Parquet: filters and column pruning reach the scan."""
    return spark.read.parquet(path)


def bucket_spread(spark: SparkSession, path: str) -> DataFrame:
    """One row: ``largest`` and ``mean`` bytes of the written buckets of a
    bucketed table, from its file listing (no file is opened)."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
             .select(F.regexp_extract("path", r"_(\d+)\.c\d+[^/]*$", 1).alias("bucket"), "length"))
    return files.groupBy("bucket").agg(F.sum("length").alias("bytes")).agg(F.max("bytes").alias("largest"), F.avg("bytes").alias("mean"))


def scan_silver_by_session(spark: SparkSession, table: str, path: str, skew: float = 4.0, least: int = 1 << 30) -> DataFrame:
    """Silver bucketed by ``user_session``: aggregates and joins on the session
    read it without an Exchange, one task a bucket.

    A session with many of the rows would make its bucket one long task: if
    the largest bucket holds over ``least`` bytes and over ``skew`` times the
    mean, the same files are read as plain Parquet, split by size, and the
    session is shuffled after map-side aggregation (AQE splits its joins)."""
    spread = bucket_spread(spark, path).first()
    if spread["largest"] is not None and spread["largest"] > max(least, skew * spread["mean"]):
        return spark.read.parquet(path)
    return spark.table(table)


def scan_gold(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{path.rstrip('/')}/{name}")


def metric_lookup(long_table: DataFrame, names: list[str], default: float | None = None) -> DataFrame:
    """Long ``(metric, value)`` table -> one wide row, a column per requested metric.

    Missing metrics get ``default``. The pivot values are given, so Spark
    needs no extra job to find them.
    """
    wide = long_table.groupBy().pivot("metric", names).agg(F.first("value"))
    return wide.select(*[F.coalesce(F.col(n), F.lit(default)).alias(n) for n in names])

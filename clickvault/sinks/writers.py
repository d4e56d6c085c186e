"""Sinks: Silver, quality audit, Gold tables, performance rows, ledger.

All writes are whole-table overwrites (or appends for the performance log)
in Parquet by default, CSV with a header on request. Paths may be any
Hadoop file-system URI.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FORMATS = ("parquet", "csv")
PARQUET_CODEC = "zstd"  # smaller than the default on these text columns


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | tuple[str, ...] | None = None) -> None:
    if fmt not in FORMATS:
        raise ValueError(f"fmt must be one of {FORMATS}, got {fmt!r}")
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).option("escape", '"').csv(path)
    else:
        w.option("compression", PARQUET_CODEC).parquet(path)


def sink_silver(silver: DataFrame, path: str, fmt: str = "parquet",
                partition_by_date: bool = False) -> None:
    """Overwrite the run's Silver table; optional ``event_date`` partitions
    give static and dynamic partition pruning to date-filtered readers. The
    rows are rebalanced by date first (a date's rows meet in few tasks, a hot
    date is split), so the files follow the data and not tasks times dates."""
    if partition_by_date:
        silver = silver.hint("rebalance", "event_date")
    write_table(silver, path, fmt, partition_by=("event_date",) if partition_by_date else None)


def sink_silver_by_session(silver: DataFrame, table: str, path: str, buckets: int) -> None:
    """Overwrite a Silver table bucketed and sorted by ``user_session`` (an
    external Parquet table at ``path``): per-session readers then need no
    shuffle. Rows are rebalanced by the bucket's own hash first, so a bucket is
    one file, small buckets share a task and a hot session is written by
    several tasks into several files of its bucket."""
    if buckets < 1:
        raise ValueError(f"buckets must be positive, got {buckets}")
    (silver.hint("rebalance", buckets, "user_session").write.mode("overwrite").format("parquet")
     .bucketBy(buckets, "user_session").sortBy("user_session").option("path", path).saveAsTable(table))


def sink_quality(report: DataFrame, rejected: DataFrame, base: str, fmt: str = "parquet") -> dict[str, str]:
    paths = {"data_quality_report": f"{base}/data_quality_report",
             "data_quality_rejected_records": f"{base}/data_quality_rejected_records"}
    write_table(report.coalesce(1), paths["data_quality_report"], fmt)
    write_table(rejected, paths["data_quality_rejected_records"], fmt)
    return paths


def run_concurrently(actions: list, max_workers: int = 8) -> list:
    """Run independent Spark actions as concurrent jobs (one driver thread
    each); the scheduler interleaves their tasks. Re-raises the first error."""
    if len(actions) <= 1:
        return [a() for a in actions]
    with ThreadPoolExecutor(max_workers=min(max_workers, len(actions))) as pool:
        futures = [pool.submit(a) for a in actions]
        return [f.result() for f in futures]


def sink_gold(tables: dict[str, DataFrame], base: str, fmt: str = "parquet",
              concurrent: bool = True) -> dict[str, str]:
    """Overwrite each Gold table under ``base/<name>``; the independent writes
    run as concurrent jobs."""
    paths = {name: f"{base}/{name}" for name in tables}
    actions = [(lambda n=name, df=df: write_table(df, paths[n], fmt)) for name, df in tables.items()]
    if concurrent:
        run_concurrently(actions)
    else:
        for a in actions:
            a()
    return paths


def sink_perf_append(perf: DataFrame, path: str, run_id: str) -> bool:
    """Append a run's performance row, with its ``run_id``, to the run log,
    unless the log has that run already: a run that is replayed (a crash came
    before its input was marked as done) adds no second row. Returns whether
    the row was added. The append is one commit; the look-up reads one column
    of the log with the id pushed down to the scan."""
    spark = perf.sparkSession
    try:
        log = spark.read.option("mergeSchema", True).parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):  # no log yet, or one without a row
            raise
        log = None
    if log is not None and "run_id" in log.columns and not log.filter(F.col("run_id") == run_id).select("run_id").isEmpty():
        return False
    write_table(perf.withColumn("run_id", F.lit(run_id)).coalesce(1), path, "parquet", mode="append")
    return True


def ledger_overwrite(ledger: DataFrame, path: str, fmt: str = "csv") -> None:
    """Replace the ledger with the complete latest suite (no stale mixed runs)."""
    write_table(ledger.coalesce(1), path, fmt, mode="overwrite")

"""Scaling runs: workloads, their manifest, timed baselines and the run ledger.

Each run is an ordinary Spark job; timing happens on the driver around one
action. The run records are written as evidence documents and read back
with Spark, so the ledger, report tables and gate use the same code as for
externally produced evidence.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickvault.operators import category as CA
from clickvault.operators import quality as Q
from clickvault.operators.workload import build_workload, dense_index
from clickvault.plans.job import JobParams, run_job
from clickvault.plans.materialize import materialize, parse_bytes
from clickvault.session import collect_garbage, fresh_path, released_shuffles, setting
from clickvault.schemas import RAW_COLUMNS
from clickvault.sources.bronze import CSV_FILES, read_bronze_csv, workload_rows, workload_size, write_bronze_csv

FILE_ROWS = 1_000_000  # a gzip file is read by one task
FILE_BYTES = 16 << 20   # about such a file: a task that looks for copies gets no more rows
SPLIT = "spark.sql.files.maxPartitionBytes"
PROVENANCE = "event rows repeated in blocks with shifted times, ids and sessions, for scaling runs"


def write_workloads(base: DataFrame, targets, root: str, order_col: str = "source_row_number",
                    first_row: int | None = None, max_records: int = 0, compression: str = "none") -> dict[int, str]:
    """Build and write ``root/ecommerce_<n>.csv`` (a CSV folder) per target;
    ``max_records`` bounds the rows of a file. Without ``first_row`` the base
    is ordered and staged once, for all targets."""
    if first_row is None:
        # written with its positions: each block then reads one and the same exchange
        base, order_col, first_row = materialize(dense_index(base, order_col, "_at"), "indexed-base"), "_at", 0
    n = base.count()
    out = {}
    for t in targets:
        path = f"{root.rstrip('/')}/ecommerce_{int(t)}.csv"
        rows = build_workload(base, int(t), order_col, first_row=first_row, n=n, in_order=True)
        write_bronze_csv(rows, path, order_col=None, max_records=max_records, compression=compression)
        out[int(t)] = path
    return out


def row_digest(columns) -> Column:
    """Mergeable content digest of a group of rows: the exact sum of the first
    60 bits of each row's SHA-256 (values tab-joined, ``\\N`` for null). Sums of
    parts add up, so files, ranges and whole workloads are compared alike,
    whatever way the rows are spread over files."""
    line = F.concat_ws("\t", *[F.coalesce(F.col(c), F.lit("\\N")) for c in columns])
    return F.sum(F.conv(F.substring(F.sha2(line, 256), 1, 15), 16, 10).cast("decimal(38,0)"))


def workload_manifest(spark: SparkSession, root: str) -> DataFrame:
    """Per written part file of all workloads under ``root``: ``sample_size
    file rows bytes row_digest provenance``. Rows are streamed through the
    CSV scan (a large file is read in splits, nothing is held whole); lengths
    come from the listing, so files without rows are listed too."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", CSV_FILES).load(f"{root.rstrip('/')}/*.csv")
             .select(F.col("path").alias("file"), F.col("length").alias("bytes")))
    rows = workload_rows(spark, root).groupBy("file").agg(F.count(F.lit(1)).alias("rows"), row_digest(RAW_COLUMNS).alias("row_digest"))
    return files.join(rows, "file", "left").select(
        workload_size(F.col("file")).alias("sample_size"), "file", F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"), "bytes",
        F.coalesce("row_digest", F.lit(0)).cast("string").alias("row_digest"), F.lit(PROVENANCE).alias("provenance"))


def manifest_by_size(manifest: DataFrame) -> DataFrame:
    """The manifest merged to one row a workload: ``sample_size files rows bytes row_digest``."""
    return manifest.groupBy("sample_size").agg(
        F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"),
        F.sum(F.col("row_digest").cast("decimal(38,0)")).cast("string").alias("row_digest"))


def table_fingerprint(df: DataFrame) -> DataFrame:
    """Order-free content fingerprint: row count and the exact sum of row hashes."""
    h = F.xxhash64(*[F.col(c) for c in df.columns]).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("rows"), F.sum(h).cast("string").alias("fingerprint"))


def local_baseline(spark: SparkSession, paths: dict[int, str]) -> DataFrame:
    """Per workload: read CSV + un-audited clean + group by type, timed as one action."""
    rows = []
    split = str(min(parse_bytes(spark.conf.get(SPLIT)), FILE_BYTES))
    for size in sorted(paths):
        t0 = time.perf_counter()
        raw = read_bronze_csv(spark, paths[size], row_numbers=False)
        with released_shuffles(spark), setting(spark, SPLIT, split):
            by_type = CA.events_by_type(Q.filter_chain(raw)).collect()
        sec = time.perf_counter() - t0
        n = sum(int(r["events"]) for r in by_type)
        rows.append(("LOCAL_SPARK_BASELINE", paths[size], n, round(sec, 4), round(n / sec, 2) if sec else None))
    return spark.createDataFrame(rows, "scope string, file string, clean_rows bigint, "
                                       "processing_seconds double, throughput_rows_per_sec double")


def _iso(t: float) -> str:
    return datetime.fromtimestamp(t, timezone.utc).isoformat()


def validation_from_runs(spark: SparkSession, root: str) -> DataFrame:
    """The per-size validation table from already evidenced runs under ``root``:
    evidence (size, seconds, the seconds until Silver was committed and those of
    Gold after it) joined with each run's quality report and KPIs,
    read back with Spark — no job is re-run."""
    from clickvault.operators.ledger import readable, scan_run_evidence
    phases = F.from_json("summary.run_output", "etl_seconds double, gold_seconds double")
    ev = readable(scan_run_evidence(spark, f"{root.rstrip('/')}/evidence/*/part-*")).select(
        F.col("summary.sample_size").alias("sample_size"), phases.alias("phases"),
        F.col("pipeline.duration_in_ms").alias("ms"))
    run = F.regexp_extract(F.col("_metadata.file_path"), r"/run_(\d+)/", 1).cast("bigint")
    report = (spark.read.parquet(f"{root.rstrip('/')}/run_*/silver/data_quality_report")
              .select(run.alias("sample_size"), "metric", "value")
              .groupBy("sample_size").pivot("metric", ["raw_rows", "clean_rows", "removed_rows"])
              .agg(F.first("value")))
    kpi = (spark.read.parquet(f"{root.rstrip('/')}/run_*/gold/kpi_summary")
           .select(run.alias("sample_size"), "metric", "value")
           .groupBy("sample_size").pivot("metric", ["unique_users", "unique_sessions"])
           .agg(F.first("value")))
    sec = F.col("ms") / F.lit(1000.0)
    return (ev.join(report, "sample_size").join(kpi, "sample_size")
            .select(F.lit("LOCAL_SPARK_FULL_PIPELINE").alias("scope"), "sample_size", "raw_rows",
                    "clean_rows", "removed_rows", F.col("unique_users").cast("bigint").alias("unique_users"),
                    F.col("unique_sessions").cast("bigint").alias("unique_sessions"),
                    F.col("phases.etl_seconds").alias("etl_seconds"), F.col("phases.gold_seconds").alias("gold_seconds"),
                    sec.alias("total_seconds"),
                    F.round(F.col("sample_size") / sec, 2).alias("throughput_rows_per_sec"))
            .orderBy("sample_size"))


def run_with_evidence(spark: SparkSession, size: int, input_path: str, root: str) -> str:
    """Run the job for one workload and write its evidence document (JSON)."""
    run_id = uuid.uuid4().hex
    base = f"{root.rstrip('/')}/run_{size}"
    t0 = time.time()
    rec = run_job(spark, JobParams(base=base, input_path=input_path, sample_size=size))
    t1 = time.time()
    ms = int(round((t1 - t0) * 1000))
    evidence_file = f"run_{size}_{run_id}.json"
    summary = {
        "sample_size": size, "source_file": input_path, "remote_path": input_path,
        "run_id": run_id, "status": "Succeeded", "run_start_utc": _iso(t0), "run_end_utc": _iso(t1),
        "pipeline_seconds": ms / 1000.0,
        "pipeline_rows_per_sec": round(size / (ms / 1000.0), 2) if ms else None,
        "activity_seconds": rec["processing_seconds"],
        "activity_rows_per_sec":
            round(size / rec["processing_seconds"], 2) if rec["processing_seconds"] else None,
        "run_output": json.dumps(rec), "evidence_file": evidence_file,
    }
    doc = {
        "scope": "LOCAL_SPARK_RUN", "captured_at_utc": _iso(time.time()),
        "upload": {"remote_path": input_path, "uploaded_bytes": None, "etag": None, "last_modified": None},
        "pipeline": {"pipeline_name": "clickvault-job", "run_id": run_id, "status": "Succeeded",
                     "run_start": _iso(t0), "run_end": _iso(t1), "duration_in_ms": ms,
                     "parameters": {"sampleSize": str(size), "inputFile": input_path}},
        "activities": [{"activity_name": "spark job", "activity_type": "SparkJob", "status": "Succeeded",
                        "start": _iso(t0), "end": _iso(t1), "duration_ms": ms,
                        "run_output": json.dumps(rec), "output": None, "error": None}],
        "summary": summary,
    }
    path = f"{root.rstrip('/')}/evidence/{evidence_file}"
    spark.createDataFrame([(json.dumps(doc),)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return path


def scaling_suite(spark: SparkSession, base: DataFrame, factors=(1, 5, 10),
                  root: str | None = None) -> str:
    """Workloads of ``factor x base rows`` (the reference's 100K:500K:1M
    shape), one evidenced job run each. Returns the root folder.

    The workloads are gzip files of at most ``FILE_ROWS`` rows, and each query
    frees its shuffle: what stays on disk are the workloads and the outputs."""
    root = root or fresh_path(spark, "scaling")
    with released_shuffles(spark):
        n = base.count()
        targets = [int(math.ceil(f * n)) for f in factors]
        paths = write_workloads(base, targets, f"{root}/samples", max_records=FILE_ROWS, compression="gzip")
        for size in targets:
            run_with_evidence(spark, size, paths[size], root)
            collect_garbage(spark)
    return root

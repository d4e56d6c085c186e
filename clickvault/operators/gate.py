"""Validation gate as data: each check is a row ``(check, expected, actual, ok)``.

Failures are collected, not raised one by one; ``gate_report`` unions all
checks and adds the overall verdict.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickvault.sources.tables import metric_lookup

CHECK_SCHEMA = "check string, expected string, actual string, ok boolean"


def _check(df: DataFrame, name: str, expected, actual) -> DataFrame:
    exp = expected if isinstance(expected, F.Column) else F.lit(expected)
    return df.select(
        F.lit(name).alias("check"),
        exp.cast("string").alias("expected"),
        actual.cast("string").alias("actual"),
        F.coalesce(actual.cast("string") == exp.cast("string"), F.lit(False)).alias("ok"),
    )


def gate_quality_counts(report: DataFrame, raw_rows: int, clean_rows: int, removed_rows: int) -> DataFrame:
    names = ["raw_rows", "clean_rows", "removed_rows"]
    wide = metric_lookup(report, names, default=-1)
    parts = [_check(wide, f"quality {n}", v, F.col(n).cast("bigint"))
             for n, v in zip(names, (raw_rows, clean_rows, removed_rows))]
    return reduce(DataFrame.unionByName, parts)


def gate_reason_counts(report: DataFrame, expected: dict[str, int]) -> DataFrame:
    """Per removal metric: expected vs the report (missing metric -> -1)."""
    names = list(expected)
    wide = metric_lookup(report, names, default=-1)
    parts = [_check(wide, f"removed {n}", expected[n], F.col(n).cast("bigint")) for n in names]
    return reduce(DataFrame.unionByName, parts)


def gate_reject_rows(rejected: DataFrame, expected: int) -> DataFrame:
    n = rejected.agg(F.count(F.lit(1)).alias("n"))
    return _check(n, "rejection audit rows", expected, F.col("n"))


def gate_tables_exist(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Path probes through the Hadoop file system (works for any FS URI)."""
    rows = []
    for name, p in paths.items():
        exists = _exists(spark, p)
        rows.append((f"exists {name}", "true", str(exists).lower(), exists))
    return spark.createDataFrame(rows, CHECK_SCHEMA)


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
    except Exception:  # remote session: probe by listing the path
        try:
            spark.read.format("binaryFile").load(path).select("path").limit(1).collect()
            return True
        except Exception:
            return False
    hp = jvm.org.apache.hadoop.fs.Path(path)
    return bool(hp.getFileSystem(conf).exists(hp))


def gate_workload_rows(workloads: DataFrame, targets) -> DataFrame:
    """``workloads``: one row per workload row with ``sample_size``; each
    target must be present with exactly ``sample_size`` rows."""
    spark = workloads.sparkSession
    counts = workloads.groupBy("sample_size").agg(F.count(F.lit(1)).alias("rows"))
    want = spark.createDataFrame([(int(t),) for t in targets], "sample_size bigint")
    j = want.join(counts, "sample_size", "left")
    return j.select(
        F.concat(F.lit("workload "), F.col("sample_size").cast("string")).alias("check"),
        F.col("sample_size").cast("string").alias("expected"),
        F.coalesce(F.col("rows").cast("string"), F.lit("missing")).alias("actual"),
        F.coalesce(F.col("rows") == F.col("sample_size"), F.lit(False)).alias("ok"),
    )


def gate_runs(ledger: DataFrame, evidence_files: DataFrame, targets) -> DataFrame:
    """Each target's run has succeeded and its evidence file exists.

    The run of a target is its latest succeeded one, the same that
    ``ledger_latest`` reports: evidence of an earlier run does not stand in
    for it. ``evidence_files``: one row per evidence document with
    ``evidence_file`` (file name)."""
    spark = ledger.sparkSession
    order = F.struct("run_end_utc", "run_id")  # nulls sort first, as in the ledger's rule
    ok = (ledger.filter(F.lower(F.col("status")) == "succeeded")
          .groupBy("sample_size").agg(F.max_by("evidence_file", order).alias("evidence_file")))
    have = evidence_files.select("evidence_file").distinct().withColumn("_has", F.lit(True))
    runs = (ok.join(have, "evidence_file", "left")
            .groupBy("sample_size").agg(F.max(F.coalesce("_has", F.lit(False))).alias("_ev")))
    want = spark.createDataFrame([(int(t),) for t in targets], "sample_size bigint")
    j = want.join(runs, "sample_size", "left")
    actual = F.when(F.col("_ev").isNull(), F.lit("no succeeded run")) \
        .when(F.col("_ev"), F.lit("succeeded with evidence")).otherwise(F.lit("evidence missing"))
    return j.select(
        F.concat(F.lit("run "), F.col("sample_size").cast("string")).alias("check"),
        F.lit("succeeded with evidence").alias("expected"),
        actual.alias("actual"),
        F.coalesce(F.col("_ev"), F.lit(False)).alias("ok"),
    )


def gate_report(*checks: DataFrame) -> DataFrame:
    """All checks plus an ``overall`` row (true only when every check passed)."""
    allc = reduce(DataFrame.unionByName, checks)
    overall = allc.agg(F.coalesce(F.bool_and("ok"), F.lit(True)).alias("ok")).select(
        F.lit("overall").alias("check"), F.lit("true").alias("expected"),
        F.col("ok").cast("string").alias("actual"), F.col("ok"))
    return allc.unionByName(overall)

"""End-to-end batch job: bronze -> audited Silver -> Gold, written once each.

Layout under ``base`` (any Hadoop FS URI): ``bronze/events`` (raw text +
row positions, Parquet), ``silver/events``, ``silver/data_quality_report``,
``silver/data_quality_rejected_records``, ``gold/<table>``, ``gold/pipeline_performance``.

Work sharing: the CSV is parsed into Bronze Parquet once; row numbering and cleaning passes
read it column-pruned; Gold reads the written Silver, and the per-user,
per-session and per-(session, category) tables are each computed once
(cached) and feed several Gold tables.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from clickvault.operators import abandonment as AB
from clickvault.operators import category as CA
from clickvault.operators import engagement as EN
from clickvault.operators import funnel as FU
from clickvault.operators import kpi as KP
from clickvault.operators import quality as Q
from clickvault.plans.materialize import release_small_sides
from clickvault.schemas import REASONS, REPORT_REASON_ORDER, SILVER
from clickvault.session import ensure_session
from clickvault.sinks.writers import run_concurrently, sink_gold, sink_perf_append, sink_silver, write_table
from clickvault.sources.bronze import number_positions, read_bronze_csv

GOLD_TABLES = ("customer_engagement", "conversion_funnel", "cart_abandonment",
               "category_performance", "kpi_summary", "metric_definitions")


@dataclass
class JobParams:
    """The run's parameters (the reference passes them as job widgets)."""
    base: str                      # output root
    input_path: str | None = None  # bronze CSV file/folder
    sample_size: int | None = None
    dedupe: str = "raw"
    quantiles: str = "exact"
    funnel_mode: str = "first_touch"
    fmt: str = "parquet"
    partition_silver_by_date: bool = False
    run_id: str | None = None      # keys the performance row: a replay of a run adds no second one

    def paths(self) -> dict[str, str]:
        b = self.base.rstrip("/")
        return {"bronze": f"{b}/bronze/events",
                "silver": f"{b}/silver/events", "report": f"{b}/silver/data_quality_report",
                "rejected": f"{b}/silver/data_quality_rejected_records", "gold": f"{b}/gold",
                "performance": f"{b}/gold/pipeline_performance"}


def _reason_metrics() -> list:
    r = F.col(Q.REASON)
    return [F.count(F.lit(1)).alias("raw_rows"), F.count_if(r.isNull()).alias("clean_rows"),
            *[F.count_if(r == x).alias(x) for x in REASONS]]


def report_from_counts(spark: SparkSession, counts: dict) -> DataFrame:
    """The 9-row report from observed counts (a fixed-size frame)."""
    raw, clean = int(counts["raw_rows"]), int(counts["clean_rows"])
    rows = [("raw_rows", raw)] + [(m, int(counts[x])) for m, x in REPORT_REASON_ORDER]
    rows += [("clean_rows", clean), ("removed_rows", raw - clean)]
    return spark.createDataFrame(rows, "metric string, value bigint")


def gold_tables(silver: DataFrame, quantiles: str = "exact", funnel_mode: str = "first_touch",
                share: bool = True, cached: list | None = None) -> dict[str, DataFrame]:
    """All Gold tables from Silver. With ``share`` the three keyed
    intermediates (per user, per session, per session x category) are
    cached and reused by the tables built from them; their lineage starts at
    the written Silver, so a lost executor recomputes cheaply. Cached frames
    are appended to ``cached`` so the caller can release them."""
    def keep(df: DataFrame) -> DataFrame:
        if not share:
            return df
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
        if cached is not None:
            cached.append(df)
        return df
    users = keep(EN.user_activity(silver))
    thr = EN.engagement_thresholds(users, quantiles)
    levels = thr.select(F.struct("users", "q33", "q67")).scalar()
    engagement = users.select("*", EN.level_expr(F.col("engagement_score"), levels).alias("engagement_level"))
    flags = keep(FU.session_flags(silver, "first_touch"))
    funnel_flags = flags if funnel_mode == "first_touch" else FU.session_flags(silver, funnel_mode)
    funnel = FU.funnel_from_counts(FU.funnel_counts(funnel_flags))
    pairs = keep(AB.session_category_flags(silver))
    abandonment = AB.cart_abandonment_from_pairs(pairs)
    return {
        "customer_engagement": engagement,
        "conversion_funnel": funnel,
        "cart_abandonment": abandonment,
        "category_performance": CA.category_performance_from_pairs(pairs),
        "kpi_summary": KP.kpi_summary(silver, users, flags, abandonment, thr),
        "metric_definitions": KP.metric_definitions(thr),
    }


def run_job(spark: SparkSession, params: JobParams, raw: DataFrame | None = None) -> dict:
    """Run the whole pipeline; returns the run record (also appended as a
    performance row). ``raw`` may replace the CSV input (a DataFrame with
    ``source_row_number`` + nine raw columns).

    Passes: the CSV is parsed once (Bronze Parquet write, keeping each row's
    split position); row numbers and everything after read column-pruned
    Parquet. The report counts are collected by the Silver write itself
    (``observe``).
    """
    ensure_session(spark)
    p = params.paths()
    run_id = params.run_id or uuid.uuid4().hex
    start = time.perf_counter()
    if raw is None:
        if not params.input_path:
            raise ValueError("input_path or raw is required")
        # one CSV parse: Bronze keeps each row's split position; row numbers
        # come from the Parquet copy (a 3-column aggregate)
        write_table(read_bronze_csv(spark, params.input_path, positions=True), p["bronze"])
        bronze = spark.read.parquet(p["bronze"])
        # row numbering and the duplicate fingerprints are independent: run both jobs at once
        keys = Q.dedupe_keys(params.dedupe)
        raw, fingerprints = run_concurrently([
            lambda: number_positions(bronze),
            lambda: Q.repeated_fingerprints(Q.with_parsed(bronze), keys)])
    else:
        write_table(raw, p["bronze"])
        raw = spark.read.parquet(p["bronze"])
        fingerprints = None
    tagged = Q.tag(raw, dedupe=params.dedupe, fingerprints=fingerprints)
    obs = Observation("quality")
    observed = tagged.observe(obs, *_reason_metrics())
    run_concurrently([
        lambda: sink_silver(Q.silver(observed), p["silver"], params.fmt, params.partition_silver_by_date),
        lambda: write_table(Q.rejected_records(tagged), p["rejected"], params.fmt),
    ])
    counts = obs.get
    report = report_from_counts(spark, counts).coalesce(1)
    silver = (spark.read.parquet(p["silver"]) if params.fmt == "parquet"
              else spark.read.option("header", True).schema(SILVER).csv(p["silver"]))
    etl = time.perf_counter() - start
    cached: list[DataFrame] = []
    gold = gold_tables(silver, params.quantiles, params.funnel_mode, cached=cached)
    # fill the shared caches once, while the report is written
    run_concurrently([df.count for df in cached] + [lambda: write_table(report, p["report"], params.fmt)])
    sink_gold(gold, p["gold"], params.fmt)
    for df in cached:
        df.unpersist()
    release_small_sides()
    elapsed = time.perf_counter() - start
    raw_rows, clean_rows = int(counts["raw_rows"]), int(counts["clean_rows"])
    record = {
        "status": "SUCCESS",
        "sample_size": params.sample_size if params.sample_size is not None else raw_rows,
        "input_file": params.input_path,
        "raw_rows": raw_rows,
        "clean_rows": clean_rows,
        "removed_rows": raw_rows - clean_rows,
        "processing_seconds": round(elapsed, 4),
        "throughput_rows_per_sec": round(clean_rows / elapsed, 2) if elapsed else 0.0,
        "etl_seconds": round(etl, 4),
        "gold_seconds": round(elapsed - etl, 4),
        "run_id": run_id,
        "silver_path": p["silver"],
        "gold_path": p["gold"],
    }
    sink_perf_append(perf_record(spark, record), p["performance"], run_id)
    return record


def perf_record(spark: SparkSession, record: dict) -> DataFrame:
    """One performance row: size, raw rows, clean rows, seconds, clean rows/s."""
    return spark.createDataFrame(
        [(int(record["sample_size"]), int(record["raw_rows"]), int(record["clean_rows"]),
          float(record["processing_seconds"]), float(record["throughput_rows_per_sec"]))],
        "sample_size bigint, raw_rows bigint, clean_rows bigint, processing_seconds double, "
        "throughput_rows_per_sec double")


def run_result_json(spark: SparkSession, record: dict) -> DataFrame:
    """The run record as one JSON document (one row, column ``result``)."""
    fields = ("status", "sample_size", "input_file", "raw_rows", "clean_rows", "removed_rows",
              "processing_seconds", "throughput_rows_per_sec", "silver_path", "gold_path")
    df = spark.createDataFrame([tuple(record.get(f) for f in fields)],
                               "status string, sample_size bigint, input_file string, raw_rows bigint, "
                               "clean_rows bigint, removed_rows bigint, processing_seconds double, "
                               "throughput_rows_per_sec double, silver_path string, gold_path string")
    return df.select(F.to_json(F.struct(*fields)).alias("result"))


#: Keys of a run's parameter document (fixed values).
PARAM_DOC = "sampleSize string, storageAccount string, fileSystem string, inputFile string"
DEFAULT_SIZE, DEFAULT_FILE_SYSTEM = 100_000, "ecommerce"


def resolve_params(documents: DataFrame, column: str = "parameters", base: str | None = None) -> DataFrame:
    """Decode parameter documents (JSON text) and resolve each run's paths:
    adds ``sample_size input_path silver_path gold_path problem``.

    A document may name size, account, file system and input file; what is
    absent or blank has its default (size 100000, file system ``ecommerce``,
    input ``bronze/ecommerce_<size>.csv``). With an account the root is that
    account's file system, else ``base``. A relative input file lies below the
    root, one with a scheme is taken as it is. Documents that are no JSON
    object, sizes that are no positive whole number and runs without a root
    get null paths and say why in ``problem``."""
    doc = F.from_json(F.col(column), PARAM_DOC + ", _broken string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"})
    given = lambda name: F.nullif(F.trim(F.col(f"_doc.{name}")), F.lit(""))
    rows = documents.withColumn("_doc", doc)
    size = F.coalesce(given("sampleSize"), F.lit(str(DEFAULT_SIZE)))
    size = F.when(size.rlike(r"\A[0-9]+\z"), size.try_cast("bigint"))
    account = given("storageAccount")
    root = F.when(account.isNotNull(), F.concat(F.lit("abfss://"), F.coalesce(given("fileSystem"), F.lit(DEFAULT_FILE_SYSTEM)),
                                                F.lit("@"), account, F.lit(".dfs.core.windows.net")))
    root = F.coalesce(root, F.lit(base.rstrip("/") if base else None).cast("string"))
    rows = rows.withColumn("sample_size", size).withColumn("_root", root).withColumn("_input", given("inputFile"))
    broken = F.col(column).isNull() | F.col("_doc._broken").isNotNull() | ~F.coalesce(F.trim(column).startswith("{"), F.lit(False))
    problem = (F.when(broken, "not a parameter document")
               .when(F.coalesce(F.col("sample_size"), F.lit(0)) <= 0, "sample size is not a positive whole number")
               .when(F.col("_root").isNull(), "no storage account and no base"))
    rows = rows.withColumn("problem", problem)
    ok = F.col("problem").isNull()
    n = F.col("sample_size").cast("string")
    file = F.coalesce(F.col("_input"), F.concat(F.lit("bronze/ecommerce_"), n, F.lit(".csv")))
    file = F.when(file.rlike(r"\A[a-zA-Z][a-zA-Z0-9+.-]*://"), file).otherwise(F.concat_ws("/", "_root", F.ltrim(file, F.lit("/"))))
    under = lambda folder: F.when(ok, F.concat(F.col("_root"), F.lit(folder), n))
    return rows.select(*documents.columns, F.when(ok, F.col("sample_size")).alias("sample_size"), F.when(ok, file).alias("input_path"),
                       under("/silver/events_").alias("silver_path"), under("/gold/run_").alias("gold_path"), "problem")

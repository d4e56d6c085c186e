"""Serving versions, rank selection, run log, manifests, evidence quarantine, run parameters."""

import random

import pytest
from pyspark.sql import functions as F

from clickvault.operators import gate as GT
from clickvault.operators import ledger as LG
from clickvault.operators import workload as WL
from clickvault.operators.engagement import approx_threshold_errors, engagement_thresholds
from clickvault.operators.ranks import exact_quantiles, rank_error, running_counts
from clickvault.operators.workload import dense_index
from clickvault.plans import benchmark as BM
from clickvault.plans.job import JobParams, resolve_params, run_job
from clickvault.schemas import LEDGER, RAW_COLUMNS
from clickvault.session import fresh_path
from clickvault.sinks import serving_store as SS
from clickvault.sinks.writers import sink_perf_append
from clickvault.sources.bronze import read_bronze_csv
from clickvault.sources.tables import raw_events
from conftest import SF001, ev, make_raw


# ---- serving versions

def _gold(spark, n):
    return {"cart_abandonment": spark.createDataFrame([(f"c{i}", i, i, 0, 1.5) for i in range(n)], "category_code string, cart_sessions long, "
                                                      "abandoned_sessions long, remove_from_cart_events long, abandonment_rate_pct double"),
            "conversion_funnel": spark.createDataFrame([(1, "view", n, 100.0, float("nan"))], "stage_order int, stage string, sessions long, "
                                                       "percent_of_view_sessions double, conversion_from_previous_stage_pct double")}


def _seen(spark, root):
    return {name: [tuple(r) for r in df.collect()] for name, df in SS.read(spark, root).items()}


def test_a_failing_table_leaves_every_table_as_it_was(spark):
    root = fresh_path(spark, "t-serving")
    assert SS.current(spark, root) == (0, {}) and SS.read(spark, root) == {}
    assert SS.refresh(spark, root, _gold(spark, 2)) == 1
    before, held = _seen(spark, root), SS.read(spark, root)
    assert len(before["cart_abandonment"]) == 2 and before["conversion_funnel"][0][-1] is None  # NaN became null
    third = spark.range(3).select(F.expr("raise_error('no')").cast("string").alias("category_code"), *[
        F.lit(0).alias(c) for c in ("views", "cart_additions", "purchases", "remove_from_cart_events", "purchase_revenue",
                                    "view_to_cart_rate_pct", "purchase_conversion_rate_pct")])
    with pytest.raises(Exception, match="no"):
        SS.refresh(spark, root, {**_gold(spark, 9), "category_performance": third})
    assert _seen(spark, root) == before and SS.current(spark, root)[0] == 1
    assert SS.refresh(spark, root, {"cart_abandonment": _gold(spark, 5)["cart_abandonment"], "conversion_funnel": None}) == 2
    after = _seen(spark, root)
    assert len(after["cart_abandonment"]) == 5 and after["conversion_funnel"] == before["conversion_funnel"]
    assert held["cart_abandonment"].count() == 2  # a reader that began before goes on with its version


def test_of_two_refreshes_at_once_one_raises(spark):
    root = fresh_path(spark, "t-serving")
    SS._publish(spark, root, 1, {"conversion_funnel": "a"})
    with pytest.raises(RuntimeError, match="another refresh"):
        SS._publish(spark, root, 1, {"conversion_funnel": "b"})
    assert SS.current(spark, root) == (1, {"conversion_funnel": "a"})
    with pytest.raises(ValueError, match="not serving tables"):
        SS.refresh(spark, root, {"events": spark.range(1)})


def test_views_follow_the_version(spark):
    root = fresh_path(spark, "t-serving")
    for n in (1, 4):
        SS.refresh(spark, root, _gold(spark, n))
        SS.publish_views(spark, root)
        assert spark.sql("SELECT count(*) FROM cart_abandonment").first()[0] == n


# ---- rank selection

def _linear(values, p):
    values = sorted(values)
    at = p * (len(values) - 1)
    lo = int(at)
    hi = min(lo + 1, len(values) - 1)
    return values[lo] * (1 - (at - lo)) + values[hi] * (at - lo)


@pytest.mark.parametrize("values", [[5], [1, 2], [3, 3, 3], [7] * 900 + [1, 100], list(range(1000)), [-5, 0, None, 2**40, 3]])
def test_quantiles_equal_a_sort(spark, values):
    probs = (0.0, 0.33, 0.5, 0.67, 1.0)
    df = spark.createDataFrame([(v,) for v in values], "v long").repartition(5)
    got = exact_quantiles(df, "v", probs).first()
    clean = [v for v in values if v is not None]
    assert got.rows == len(clean)
    assert got.quantiles == pytest.approx([_linear(clean, p) for p in probs])


def test_quantiles_of_random_values_and_of_none(spark):
    rng = random.Random(4)
    values = [int(rng.paretovariate(0.7)) for _ in range(3000)]
    got = exact_quantiles(spark.createDataFrame([(v,) for v in values], "v long"), "v", (0.33, 0.67)).first()
    assert got.quantiles == pytest.approx([_linear(values, 0.33), _linear(values, 0.67)])
    none = exact_quantiles(spark.createDataFrame([], "v long"), "v", (0.5,)).first()
    assert (none.rows, none.quantiles) == (0, [None])
    users = spark.createDataFrame([], "engagement_score long")
    assert tuple(engagement_thresholds(users).first()) == (0, 0.0, 0.0)


def test_no_task_merges_all_values(spark):
    df = spark.range(5000).select((F.col("id") % 700).alias("v")).repartition(6)
    assert sum(r.n for r in running_counts(df, "v").collect()) == 5000
    plan = exact_quantiles(df, "v", (0.5,))._jdf.queryExecution().executedPlan().toString().lower()
    assert "percentile" not in plan and "objecthashaggregate" not in plan


def test_approximate_thresholds_know_their_rank_error(spark):
    users = spark.range(4001).select((F.col("id") * 7 % 4001).alias("engagement_score"))
    assert all(r.within for r in approx_threshold_errors(users).collect())
    off = users.agg(rank_error(users, "engagement_score", F.lit(400), 0.33, F.count(F.lit(1))).alias("e")).first().e
    assert off == pytest.approx(0.33 - 401 / 4001)


# ---- run log and phases

def test_a_replayed_run_adds_no_row(spark):
    path = fresh_path(spark, "t-perf")
    for run, n in (("a", 1), ("b/1", 2), ("b/1", 3)):
        sink_perf_append(spark.createDataFrame([(n,)], "raw_rows long"), path, run)
    assert sorted((r.run_id, r.raw_rows) for r in spark.read.parquet(path).collect()) == [("a", 1), ("b/1", 2)]


def test_phases_add_up(spark):
    rec = run_job(spark, JobParams(base=fresh_path(spark, "t-job"), run_id="r1"), raw=raw_events(spark, SF001).filter("source_row_number < 200"))
    assert rec["run_id"] == "r1" and rec["etl_seconds"] > 0 and rec["gold_seconds"] > 0
    assert rec["etl_seconds"] + rec["gold_seconds"] == pytest.approx(rec["processing_seconds"], abs=0.001)
    log = spark.read.parquet(f"{rec['gold_path']}/pipeline_performance").collect()
    assert [r.run_id for r in log] == ["r1"]


# ---- manifest

def test_manifest_equals_a_recount_whatever_the_files(spark):
    raw = make_raw(spark, [ev(sess=f"s{i}", cat=None if i % 3 else 'a "quoted", one', price="") for i in range(25)])
    by = {}
    for most in (0, 4):
        root = fresh_path(spark, "t-manifest")
        BM.write_workloads(raw, [25, 60], root, max_records=most)
        files = BM.workload_manifest(spark, root)
        if most:
            assert max(r.rows for r in files.collect()) <= most
        listed = spark.read.format("binaryFile").load([f"{root}/ecommerce_25.csv/*.csv", f"{root}/ecommerce_60.csv/*.csv"])
        assert files.agg(F.sum("bytes")).first()[0] == listed.agg(F.sum("length")).first()[0]
        by[most] = {r.sample_size: (r.rows, r.row_digest) for r in BM.manifest_by_size(files).collect()}
    assert by[0] == by[4] and {k: v[0] for k, v in by[0].items()} == {25: 25, 60: 60}
    other = make_raw(spark, [ev(sess=f"s{i}") for i in range(25)])
    digest = other.agg(BM.row_digest(RAW_COLUMNS).alias("d")).first().d
    assert str(digest) != by[0][25][1]


# ---- evidence

def test_unreadable_documents_are_reported(spark):
    path = fresh_path(spark, "t-evidence")
    good = '{"pipeline":\n {"run_id": "r1", "status": "Succeeded", "duration_in_ms": 2000},\n "summary": {"sample_size": 10}}'
    docs = {"good": good, "cut": good[:60], "type": '{"pipeline": {"run_id": "r2", "duration_in_ms": "soon"}}', "list": "[1, 2]"}
    for name, text in docs.items():
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{path}/{name}.json")
    got = LG.scan_run_evidence(spark, f"{path}/*.json/part-*").cache()
    bad = {r.evidence_path.split("/")[-2]: r.corrupt_document.rstrip("\n") for r in LG.quarantined(got).collect()}
    assert bad == {k + ".json": v for k, v in docs.items() if k != "good"}
    assert all(r.pipeline is None and r.summary is None for r in got.filter("corrupt_document IS NOT NULL").collect())
    rows = LG.ledger_row(got).collect()
    assert [(r.run_id, r.pipeline_seconds, r.pipeline_rows_per_sec) for r in rows] == [("r1", 2.0, 5.0)]


def test_the_gate_looks_at_the_latest_run(spark):
    rows = [{"sample_size": n, "status": s, "run_id": r, "run_end_utc": t, "evidence_file": f"{r}.json"} for n, s, r, t in [
        (1, "Succeeded", "old", "2024-01-01"), (1, "succeeded", "new", "2024-01-02"), (2, "Succeeded", "x", None), (2, "Succeeded", "y", "2024"),
        (3, "Failed", "z", "2024")]]
    ledger = spark.createDataFrame([tuple(r.get(f.name) for f in LEDGER.fields) for r in rows], LEDGER)
    files = spark.createDataFrame([("old.json",), ("y.json",), ("z.json",)], "evidence_file string")
    got = {r.check: (r.actual, r.ok) for r in GT.gate_runs(ledger, files, [1, 2, 3]).collect()}
    assert got == {"run 1": ("evidence missing", False), "run 2": ("succeeded with evidence", True), "run 3": ("no succeeded run", False)}
    assert {r.run_id for r in LG.ledger_latest(ledger, [1, 2]).collect()} == {"new", "y"}


# ---- parameters

def test_parameter_documents(spark):
    docs = ['{"sampleSize": "500000", "storageAccount": "acct"}', "{}", '{"sampleSize": 7, "inputFile": "/x/y.csv"}', '{"sampleSize": "0"}',
            '{"sampleSize": "1e3"}', "", None, "[]", '{"sampleSize": "5"', '{"inputFile": "s3a://o/in.csv", "storageAccount": "a", "fileSystem": "f"}']
    df = spark.createDataFrame([(d,) for d in docs], "parameters string")
    got = {r.parameters: r for r in resolve_params(df, base="hdfs://lake/").collect()}
    root = "abfss://ecommerce@acct.dfs.core.windows.net"
    assert tuple(got[docs[0]])[1:] == (500000, f"{root}/bronze/ecommerce_500000.csv", f"{root}/silver/events_500000", f"{root}/gold/run_500000", None)
    assert got["{}"].input_path == "hdfs://lake/bronze/ecommerce_100000.csv" and got["{}"].gold_path == "hdfs://lake/gold/run_100000"
    assert got[docs[2]].input_path == "hdfs://lake/x/y.csv" and got[docs[2]].sample_size == 7
    assert got[docs[9]].input_path == "s3a://o/in.csv" and got[docs[9]].silver_path == "abfss://f@a.dfs.core.windows.net/silver/events_100000"
    assert all("whole number" in got[d].problem and got[d].input_path is None for d in docs[3:5])
    assert all(got[d].problem == "not a parameter document" for d in ("", None, "[]", docs[8]))
    assert resolve_params(df).filter("parameters = '{}'").first().problem == "no storage account and no base"


def test_workloads_order_their_base_once(spark, monkeypatch):
    raw = make_raw(spark, [ev(sess=f"s{i}") for i in range(7)]).withColumn("source_row_number", F.col("source_row_number") * 5)
    calls = []

    def counted(*args):
        calls.append(args)
        return dense_index(*args)

    monkeypatch.setattr(WL, "dense_index", counted)
    monkeypatch.setattr(BM, "dense_index", counted, raising=False)
    paths = BM.write_workloads(raw, [3, 7, 17], fresh_path(spark, "once"))
    assert len(calls) == 1
    for n, path in paths.items():
        rows = read_bronze_csv(spark, path).orderBy("source_row_number").select("user_session").collect()
        assert [r.user_session for r in rows] == [f"s{i % 7}-b{i // 7:04d}" for i in range(n)]

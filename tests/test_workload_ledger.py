"""Workload amplification (FIXTURES §C), bronze CSV round trip, ledger rules."""

import json

import pytest
from pyspark.sql import functions as F

from clickvault.operators import funnel as FU
from clickvault.operators import ledger as LG
from clickvault.operators import quality as Q
from clickvault.operators.workload import build_workload, suffix_session
from clickvault.session import fresh_path
from clickvault.sources.bronze import read_bronze_csv, write_bronze_csv
from clickvault.sources.tables import raw_events
from conftest import SF001, ev, make_raw


def _summary(spark, wl):
    s = Q.silver(Q.tag(wl)).cache()
    a = s.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("u"),
              F.countDistinct("user_session").alias("s"),
              F.round(F.sum(F.when(F.col("event_type") == "purchase", F.col("price"))), 2).alias("rev")).first()
    f = [r.sessions for r in FU.conversion_funnel(s).orderBy("stage_order").collect()]
    return a.n, a.u, a.s, f, a.rev


@pytest.mark.parametrize("target,expected", [
    (2500, (1861, 45, 887, [362, 57, 9], 24794.70)),
    (3030, (2265, 45, 1083, [441, 72, 12], 30130.53)),
])
def test_workload_fixture_numbers(spark, target, expected):
    wl = build_workload(raw_events(spark, SF001), target)
    assert wl.count() == target
    n, u, s, f, rev = _summary(spark, wl)
    assert (n, u, s, f) == expected[:4]
    assert rev == pytest.approx(expected[4])


def test_full_blocks_multiply_additive_counts(spark):
    raw = raw_events(spark, SF001)
    one = {r.metric: r.value for r in Q.quality_report(Q.tag(build_workload(raw, 1010))).collect()}
    three = {r.metric: r.value for r in Q.quality_report(Q.tag(build_workload(raw, 3030))).collect()}
    assert all(three[k] == 3 * one[k] for k in one)


def test_contiguous_rows_need_no_ordering_job(spark):
    raw = make_raw(spark, [ev(sess=f"s{i}") for i in range(5)])
    wl = build_workload(raw, 12, first_row=2, n=5).orderBy("source_row_number").collect()
    assert [r.source_row_number for r in wl] == list(range(2, 14))
    assert wl[5].user_session == "s0-b0001" and wl[11].user_session == "s1-b0002"
    assert wl[5].event_time == "2019-10-02 10:00:00 UTC" and wl[5].user_id == str(7 + 1_000_000)


def test_suffix_five_digit_block_and_null(spark):
    got = spark.createDataFrame([("s", 12345), (None, 3)], "s string, b int") \
        .select(suffix_session("s", F.col("b")).alias("x")).collect()
    assert [r.x for r in got] == ["s-b12345", None]


def test_target_must_be_positive(spark):
    with pytest.raises(ValueError):
        build_workload(make_raw(spark, [ev()]), 0, n=1)


def test_bronze_csv_round_trip_row_numbers_and_tokens(spark):
    raw = make_raw(spark, [ev(brand="NA", sess=f"s{i}") if i == 3 else ev(sess=f"s{i}", typ="  View\t")
                           for i in range(40)])
    path = fresh_path(spark, "t-csv")
    write_bronze_csv(raw.repartition(4), path)
    back = read_bronze_csv(spark, path).orderBy("source_row_number").collect()
    assert [r.source_row_number for r in back] == list(range(2, 42))
    assert [r.user_session for r in back] == [f"s{i}" for i in range(40)]
    assert back[3].brand is None and back[0].event_type == "  View\t"


def test_require_columns(spark):
    path = fresh_path(spark, "t-bad-csv")
    spark.createDataFrame([("a", "b")], "event_time string, x string").write.option("header", True).csv(path)
    with pytest.raises(ValueError, match="Missing required columns"):
        read_bronze_csv(spark, path)


def _evidence(spark, docs):
    path = fresh_path(spark, "t-evidence")
    for i, d in enumerate(docs):  # one document per file, pretty-printed
        spark.createDataFrame([(json.dumps(d, indent=2),)], "value string").coalesce(1) \
            .write.text(f"{path}/doc{i}.json")
    return LG.scan_run_evidence(spark, f"{path}/*")


def _doc(size, run, status="Succeeded", ms=2000, end="2026-01-01T00:00:00+00:00", acts=None):
    return {"scope": "x", "captured_at_utc": end,
            "pipeline": {"run_id": run, "status": status, "run_end": end, "duration_in_ms": ms},
            "activities": acts if acts is not None else [],
            "summary": {"sample_size": size, "evidence_file": f"{run}.json"}}


def test_ledger_rules(spark):
    acts = [{"activity_name": "copy", "activity_type": "Copy", "duration_ms": 1},
            {"activity_name": "Run Notebook", "activity_type": None, "duration_ms": 1500}]
    ev_ = _evidence(spark, [
        _doc(100, "a", "SUCCEEDED", end="2026-01-01T00:00:00+00:00", acts=acts),
        _doc(100, "b", "succeeded", end="2026-01-02T00:00:00+00:00"),
        _doc(500, "c", "Failed"),
        _doc(1000, "d", ms=0),
        _doc(1000, "e", ms=None, end="2025-01-01T00:00:00+00:00"),
    ])
    ledger = LG.ledger_row(ev_)
    rows = {r.run_id: r for r in ledger.collect()}
    assert rows["a"].activity_seconds == 1.5 and rows["a"].pipeline_rows_per_sec == 50.0
    assert rows["d"].pipeline_rows_per_sec is None and rows["e"].pipeline_seconds is None
    latest = LG.ledger_latest(ledger, (100, 500, 1000)).collect()
    assert [(r.sample_size, r.run_id) for r in latest] == [(100, "b"), (1000, "d")]
    assert [r.sample_size for r in LG.ledger_missing(ledger, (100, 500, 1000)).collect()] == [500]
    assert LG.ledger_table(ledger, (100, 500, 1000)).columns == list(LG.REPORT_COLUMNS)


def test_gzip_csv_header_and_row_numbers(spark):
    raw = make_raw(spark, [ev(sess=f"s{i}") for i in range(30)])
    path = fresh_path(spark, "t-gz")
    (raw.repartitionByRange(3, "source_row_number").sortWithinPartitions("source_row_number")
     .select(*[c for c in raw.columns if c != "source_row_number"])
     .write.option("header", True).option("compression", "gzip").csv(path))
    back = read_bronze_csv(spark, path).orderBy("source_row_number").collect()
    assert [r.source_row_number for r in back] == list(range(2, 32))
    assert [r.user_session for r in back] == [f"s{i}" for i in range(30)]


def test_gate_counts_written_workloads(spark):
    from clickvault.operators import gate as GT
    from clickvault.session import fresh_path
    from clickvault.sources.bronze import write_bronze_csv, written_workloads
    raw = make_raw(spark, [ev(uid=str(i)) for i in range(4)])
    root = fresh_path(spark, "t-workloads")
    for size, name in ((4, 4), (10, 10), (7, 9)):  # the last one lies under a wrong size
        write_bronze_csv(build_workload(raw, size, n=4), f"{root}/ecommerce_{name}.csv")
    got = {r.check: (r.actual, r.ok) for r in GT.gate_workload_rows(written_workloads(spark, root), [4, 10, 9, 12]).collect()}
    assert got == {"workload 4": ("4", True), "workload 10": ("10", True), "workload 9": ("7", False), "workload 12": ("missing", False)}

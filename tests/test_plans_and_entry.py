"""Plan checks, properties and the driver contract."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from clickvault.operators import abandonment as AB
from clickvault.operators import category as CA
from clickvault.operators import funnel as FU
from clickvault.operators import quality as Q
from clickvault.plans.job import JobParams, run_job
from clickvault.session import fresh_path
from clickvault.sources.tables import raw_events
from conftest import SF001

PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _outside_cache(plan: str) -> str:
    """Plan text without the subtrees of cached relations (their own plans)."""
    out, skip_indent = [], None
    for line in plan.splitlines():
        indent = len(line) - len(line.lstrip(" :+-"))
        if skip_indent is not None and indent > skip_indent:
            continue
        skip_indent = None
        out.append(line)
        if "InMemoryRelation" in line or "InMemoryTableScan" in line:
            skip_indent = indent
    return "\n".join(out)


def test_tag_plan_no_row_shuffle_no_python(spark):
    tagged = Q.tag(raw_events(spark, SF001))
    plan = _plan(tagged)
    assert not any(p in plan for p in PY_NODES)
    # the rows reach the reasons through broadcast joins only
    main = _outside_cache(plan)
    assert "BroadcastHashJoin" in main
    assert "Exchange hashpartitioning" not in main and "SortMergeJoin" not in main


def test_gold_plans_have_no_python(spark):
    s = Q.silver(Q.tag(raw_events(spark, SF001)))
    for df in (CA.category_performance(s), AB.cart_abandonment(s), FU.conversion_funnel(s)):
        assert not any(p in _plan(df) for p in PY_NODES)


def test_properties(spark):
    t = Q.tag(raw_events(spark, SF001))
    r = {x.metric: x.value for x in Q.quality_report(t).collect()}
    assert r["raw_rows"] == r["clean_rows"] + sum(v for k, v in r.items() if k.endswith("_rows_removed"))
    s = Q.silver(t)
    f = [x.sessions for x in FU.conversion_funnel(s).orderBy("stage_order").collect()]
    assert f[0] >= f[1] >= f[2]
    for row in AB.cart_abandonment(s).collect():
        assert row.abandoned_sessions <= row.cart_sessions
    views = CA.category_performance(s).agg(F.sum("views")).first()[0]
    assert views == s.filter(F.col("event_type") == "view").count()


def test_job_end_to_end(spark):
    base = fresh_path(spark, "t-job")
    rec = run_job(spark, JobParams(base=base), raw=raw_events(spark, SF001))
    assert (rec["raw_rows"], rec["clean_rows"]) == (1010, 755)
    p = JobParams(base=base).paths()
    kpi = {x.metric: x.value for x in spark.read.parquet(f"{p['gold']}/kpi_summary").collect()}
    assert kpi["unique_users"] == 15 and kpi["unique_sessions"] == 361
    assert kpi["cart_sessions"] == 24 and kpi["overall_cart_abandonment_rate_pct"] == 93.0481
    rep = spark.read.parquet(p["report"])
    assert {x.metric: x.value for x in rep.collect()}["duplicate_rows_removed"] == 5
    assert spark.read.parquet(p["performance"]).count() == 1


def test_entry_and_contract(spark):
    df = E.entry(spark)
    assert df.count() == 7
    assert set(E.oracle_sql()) <= set(E.queries())


ORACLE_SUBSET = ["quality_report", "silver_events", "customer_engagement", "conversion_funnel",
                 "conversion_funnel_any_after", "cart_abandonment", "category_performance", "kpi_summary",
                 "silver_by_session", "funnel_by_session", "session_category_by_session",
                 "metric_definitions", "build_workload", "gate_report", "row_number_src", "serving_load"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("events", "part"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def _norm(rows):
    out = []
    for r in rows:
        out.append(tuple(round(v, 6) if isinstance(v, float) else v for v in r))
    return sorted(out, key=repr)


@pytest.mark.parametrize("name", ORACLE_SUBSET)
def test_oracle_sf0001(spark, duck, name):
    sdf = E.queries()[name](spark, SF001)
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    srows = [tuple(r[c] for c in dcols) for r in sdf.collect()]
    assert _norm(srows) == _norm(drows)


def test_one_scan_per_gold_table_and_pruned_schema(spark):
    path = fresh_path(spark, "t-silver")
    Q.silver(Q.tag(raw_events(spark, SF001))).write.parquet(path)
    silver = spark.read.parquet(path)
    for df in (CA.category_performance(silver), AB.cart_abandonment(silver), FU.conversion_funnel(silver)):
        plan = _plan(df)
        assert plan.count("FileScan parquet") == 1, plan
    plan = _plan(CA.category_performance(silver))
    assert "ReadSchema: struct<event_type:string,category_code:string,price:double>" in plan


def test_silver_by_session_needs_no_exchange(spark):
    from clickvault.sinks.writers import sink_silver_by_session
    from clickvault.sources.tables import bucket_spread, scan_silver_by_session
    silver = Q.silver(Q.tag(raw_events(spark, SF001)))
    path = fresh_path(spark, "t-by-session")
    sink_silver_by_session(silver, "t_by_session", path, buckets=6)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        by = scan_silver_by_session(spark, "t_by_session", path)
        for df in (FU.session_flags(by), FU.session_flags_any_after(by), AB.session_category_flags(by)):
            plan = _plan(df)
            assert "Exchange" not in plan and "Bucketed: true" in plan, plan
        for mode in FU.MODES:
            assert sorted(map(tuple, FU.conversion_funnel(by, mode).collect())) == sorted(map(tuple, FU.conversion_funnel(silver, mode).collect()))
        # a bucket that is too large for one task: plain files, with an Exchange, same rows
        plain = scan_silver_by_session(spark, "t_by_session", path, skew=0.5, least=1)
        assert "Exchange" in _plan(FU.session_flags(plain)) and "Bucketed: true" not in _plan(plain)
        assert plain.exceptAll(by).count() == 0 and by.count() == plain.count() == 755
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    files = {f.rsplit("_", 1)[1] for f in by.inputFiles()}
    spread = bucket_spread(spark, path).first()
    assert len(by.inputFiles()) == len(files) <= 6 and spread["largest"] >= spread["mean"] > 0
    sink_silver_by_session(silver.limit(0), "t_by_session", path, buckets=6)
    assert scan_silver_by_session(spark, "t_by_session", path).count() == 0
    with pytest.raises(ValueError):
        sink_silver_by_session(silver, "t_by_session", path, buckets=0)


def test_serving_sql_equals_dataframe_form(spark):
    from clickvault.operators import serving as SV
    from clickvault.plans.catalog import register_gold_views
    gold = register_gold_views(spark, Q.silver(Q.tag(raw_events(spark, SF001))))
    pairs = [("sql_top_engagement", SV.top_engagement(gold["customer_engagement"])),
             ("sql_top_abandonment", SV.top_abandonment(gold["cart_abandonment"])),
             ("sql_top_revenue", SV.top_revenue(gold["category_performance"])),
             ("sql_total_revenue", SV.total_revenue(gold["category_performance"])),
             ("sql_top_conversion", SV.top_conversion(gold["category_performance"]))]
    for name, df in pairs:
        assert [tuple(r) for r in spark.sql(SV.SERVING_SQL[name]).collect()] == [tuple(r) for r in df.collect()], name


def test_job_from_csv_numbers_rows_like_the_reader(spark):
    from clickvault.sources.bronze import read_bronze_csv, write_bronze_csv
    csv = fresh_path(spark, "t-job-csv")
    write_bronze_csv(raw_events(spark, SF001), csv)
    base = fresh_path(spark, "t-job-from-csv")
    rec = run_job(spark, JobParams(base=base, input_path=csv))
    assert (rec["raw_rows"], rec["clean_rows"]) == (1010, 755)
    p = JobParams(base=base).paths()
    got = {(r.source_row_number, r.rejection_reason) for r in spark.read.parquet(p["rejected"]).collect()}
    want = {(r.source_row_number, r.rejection_reason)
            for r in Q.rejected_records(Q.tag(read_bronze_csv(spark, csv))).collect()}
    assert got == want and len(got) == 255


def test_audit_without_broadcasts_gives_same_numbers(spark):
    """The path taken when repeated keys are too many to broadcast: written
    sides and sort-merge joins (AQE), same report."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tagged = Q.tag(raw_events(spark, SF001))
        plan = _outside_cache(_plan(tagged))
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
        r = {x.metric: x.value for x in Q.quality_report(tagged).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert (r["raw_rows"], r["duplicate_rows_removed"], r["clean_rows"]) == (1010, 5, 755)


def test_parse_bytes():
    from clickvault.plans.materialize import parse_bytes
    assert parse_bytes("10485760b") == parse_bytes("10MB") == parse_bytes("10m") == 10 * 1024 * 1024
    assert parse_bytes("-1") == -1 and parse_bytes("2g") == 2 << 30


def test_job_from_csv_normalised_rule(spark):
    from clickvault.sources.bronze import write_bronze_csv
    csv = fresh_path(spark, "t-job-csv-n")
    write_bronze_csv(raw_events(spark, SF001), csv)
    rec = run_job(spark, JobParams(base=fresh_path(spark, "t-job-n"), input_path=csv, dedupe="normalised"))
    assert (rec["raw_rows"], rec["clean_rows"]) == (1010, 752)

"""What the scaling suite leaves and moves on disk."""

import os
import time

from pyspark.sql import functions as F

from clickvault.operators import quality as Q
from clickvault.operators.workload import build_workload
from clickvault.plans import benchmark as BM
from clickvault.plans.materialize import release_small_sides
from clickvault.schemas import RAW_COLUMNS
from clickvault.session import fresh_path, released_shuffles
from clickvault.sources.bronze import read_bronze_csv, sample_sizes, write_bronze_csv
from conftest import ev, make_raw


def _shuffles(spark) -> set[str]:
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {n for d in disk.localDirs() for _, _, files in os.walk(d.getPath()) for n in files if n.startswith("shuffle_")}


def _left(spark, before: set[str]) -> set[str]:
    for _ in range(50):  # files are removed after the query's end, in the background
        if not (left := _shuffles(spark) - before):
            break
        time.sleep(0.2)
    return left


def _many(spark, n):
    """``n`` raw rows in reverse, numbered 3, 6, 9, ..."""
    i = F.col("id")
    text = {"event_time": F.lit("2019-10-01 10:00:00 UTC"), "event_type": F.lit("view"), "price": F.lit("10.0"), "user_session": F.concat(F.lit("s"), i.cast("string")),
            "product_id": (i % 5).cast("string"), "user_id": (i % 9).cast("string"), "brand": F.when(i % 7 > 0, F.lit("a, \"b\""))}
    return spark.range(n - 1, -1, -1, 3).select(((i + 1) * 3).alias("source_row_number"), *[
        text.get(c, F.lit("1")).alias(c) for c in RAW_COLUMNS])


# ---- F1: workloads

def test_a_large_base_is_shuffled_once_for_all_its_blocks(spark):
    n = 1000 * spark.sparkContext.defaultParallelism + 50
    path = fresh_path(spark, "t-base")
    _many(spark, n).write.parquet(path)
    base = spark.read.parquet(path).withColumn("at", F.floor(F.col("source_row_number") / 3) - 1)
    for target, exchanges in ((4 * n, 1), (3 * n + 7, 2)):  # a block that is cut reads its own
        rows = build_workload(base, target, "at", first_row=0, n=n, in_order=True)
        got = rows.collect()
        final = rows._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert final.count("- Exchange rangepartitioning") <= exchanges  # the others read that one: ReusedExchange
        assert [r.source_row_number for r in got] == list(range(2, target + 2))
        assert [r.user_session for r in got] == [f"s{i % n}-b{i // n:04d}" for i in range(target)]
        plain = build_workload(base, target, "at", first_row=0, n=n)
        assert plain.exceptAll(rows).isEmpty() and plain.count() == target


def test_suite_writes_small_workloads_and_frees_its_shuffles(spark):
    before = _shuffles(spark)
    raw = make_raw(spark, [ev(sess=f"s{i}", uid=str(i)) for i in range(30)])
    setting = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None)
    root = BM.scaling_suite(spark, raw, factors=(1, 3))
    left = _left(spark, before)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) == setting
    for n in (30, 90):
        at = f"{root}/samples/ecommerce_{n}.csv"
        names = [f for f in os.listdir(at) if f.startswith("part-")]
        assert names and all(f.endswith(".csv.gz") for f in names)
        back = read_bronze_csv(spark, at).orderBy("source_row_number").select("user_session").collect()
        assert [r.user_session for r in back] == [f"s{i % 30}-b{i // 30:04d}" for i in range(n)]
    found = sample_sizes(spark, f"{root}/samples/*/*.csv*").collect()
    assert [(r.sample_size, r.file.rsplit("/", 1)[1]) for r in found] == [(30, "ecommerce_30.csv"), (90, "ecommerce_90.csv")]
    files = BM.manifest_by_size(BM.workload_manifest(spark, f"{root}/samples")).select("sample_size", "rows").collect()
    assert sorted(map(tuple, files)) == [(30, 30), (90, 90)]
    assert not left


def test_rows_without_a_position_are_left_out_as_before(spark):
    n = 1000 * spark.sparkContext.defaultParallelism + 50
    base = _many(spark, n).withColumn("at", F.when(F.col("source_row_number") > 6, F.floor(F.col("source_row_number") / 3) - 1))
    rows = build_workload(base, 2 * n, "at", first_row=0, n=n, in_order=True)
    plain = build_workload(base, 2 * n, "at", first_row=0, n=n)
    assert rows.count() == 2 * (n - 2) and plain.exceptAll(rows).isEmpty()


# ---- F2: the timed baseline

def test_baseline_frees_its_shuffles(spark):
    path = fresh_path(spark, "t-baseline")
    write_bronze_csv(make_raw(spark, [ev(sess=f"s{i % 20}") for i in range(40)]), path)
    read_bronze_csv(spark, path, row_numbers=False).count()
    before = _shuffles(spark)
    kept = BM.local_baseline(spark, {40: path})
    assert kept.select("clean_rows").first().clean_rows == 20
    assert not _left(spark, before)


def test_released_shuffles_sets_back_what_was_set(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.conf.get(key, None)
    try:
        spark.conf.set(key, "false")
        with released_shuffles(spark):
            assert spark.conf.get(key) == "true"
        assert spark.conf.get(key) == "false"
    finally:
        spark.conf.set(key, old) if old is not None else spark.conf.unset(key)


# ---- F3: duplicates too many to broadcast

def test_only_rows_that_may_repeat_are_staged(spark, monkeypatch):
    raw = _many(spark, 3000)
    again = raw.filter(F.col("source_row_number") <= 60).withColumn("source_row_number", F.col("source_row_number") + 100_000)
    empty = make_raw(spark, [(None,) * 9] * 3).withColumn("source_row_number", F.col("source_row_number") + 200_000)
    rows = raw.unionByName(again).unionByName(empty)
    want = {r.source_row_number: r._is_duplicate for r in Q.mark_duplicates(rows, RAW_COLUMNS).collect()}
    staged, write = {}, Q.materialize

    def counted(df, name):
        got = write(df, name)
        staged[name] = got.count()
        return got

    monkeypatch.setattr(Q, "materialize", counted)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = {r.source_row_number: r._is_duplicate for r in Q.mark_duplicates(rows, RAW_COLUMNS).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        release_small_sides()
    assert got == want and sum(want.values()) == 20 + 2
    assert 43 <= max(staged.values()) <= 43 + 300  # two copies of 20 rows, three of one, few others
    monkeypatch.setattr(Q, "FLAG_BITS", 64)  # a full bitmap lets more rows through, never fewer
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert {r.source_row_number: r._is_duplicate for r in Q.mark_duplicates(rows, RAW_COLUMNS).collect()} == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        release_small_sides()

"""Landing-folder trigger: each landed CSV file gets one job run."""

from pyspark.sql import functions as F

from clickvault.session import fresh_path
from clickvault.sources.tables import raw_events
from clickvault.streaming import run_name, start_landing_trigger
from conftest import SF001


def test_run_name():
    assert run_name("file:/x/landing/ecommerce_100000.csv") == "ecommerce_100000"


def test_each_landed_file_runs_the_job(spark):
    raw = raw_events(spark, SF001).orderBy("source_row_number")
    landing = fresh_path(spark, "t-landing")
    cols = [c for c in raw.columns if c != "source_row_number"]
    first = raw.filter(F.col("source_row_number") < 600).select(*cols)
    second = raw.filter(F.col("source_row_number") >= 600).select(*cols)
    for name, part in (("a", first), ("b", second)):
        (part.coalesce(1).write.option("header", True).option("ignoreLeadingWhiteSpace", False)
         .option("ignoreTrailingWhiteSpace", False).csv(f"{landing}/{name}"))
    out = fresh_path(spark, "t-landing-out")
    q = start_landing_trigger(spark, landing, out, max_files_per_trigger=1)
    q.awaitTermination(300)
    assert q.exception() is None
    reports = spark.read.parquet(f"{out}/*/silver/data_quality_report")
    raw_total = reports.filter("metric = 'raw_rows'").agg(F.sum("value")).first()[0]
    assert raw_total == 1010
    runs = spark.read.parquet(f"{out}/*/gold/pipeline_performance").count()
    assert runs == 2


def test_a_data_set_of_parts_is_one_run_and_equal_names_stay_apart(spark):
    raw = raw_events(spark, SF001).filter(F.col("source_row_number") < 300)
    whole = raw.unionByName(raw).drop("source_row_number")  # copies lie in other parts than their originals
    landing, out = fresh_path(spark, "t-landing"), fresh_path(spark, "t-landing-out")
    for folder, n in (("2024-01/events", 3), ("2024-02/events", 1)):
        (whole.repartition(n).write.option("header", True).option("ignoreLeadingWhiteSpace", False)
         .option("ignoreTrailingWhiteSpace", False).csv(f"{landing}/{folder}"))
    checkpoint = fresh_path(spark, "t-landing-cp")
    for again in range(2):  # the second stream replays every file
        q = start_landing_trigger(spark, landing, out, checkpoint=f"{checkpoint}-{again}")
        q.awaitTermination(300)
        assert q.exception() is None
    for folder in ("2024-01/events", "2024-02/events"):
        runs = [r.raw_rows for r in spark.read.parquet(f"{out}/{folder}/gold/pipeline_performance").collect()]
        report = {r.metric: r.value for r in spark.read.parquet(f"{out}/{folder}/silver/data_quality_report").collect()}
        assert runs == [whole.count()] and report["clean_rows"] <= raw.count()

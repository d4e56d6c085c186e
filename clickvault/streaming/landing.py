"""Landing-folder trigger: every new data set of event CSV starts one batch job run.

The reference's runs are started by an orchestrator once a workload file is
uploaded. Here a Structured Streaming query watches the landing folder
(``binaryFile`` source with only ``path``/``length`` selected, so file
contents are not read by the stream) and ``foreachBatch`` runs the batch job
for each new data set. A data set is one CSV file, or the folder of part files
(``part-*``) that a distributed writer finished with ``_SUCCESS``: one run reads
all its parts, whichever of them the stream sees first. Parts without the
marker are waited for, then the batch fails, and a restart tries them again.

The stream's checkpoint records which files were handled, so a restart after
a failure resumes with the files not yet processed. Outputs lie under the data
set's path relative to the landing folder; the files that a run has read are
listed there in ``_inputs``, so the remaining parts of a data set, or a
replayed batch, start no second run, and a data set that has changed does.

A micro-batch's file list is bounded by ``maxFilesPerTrigger``; that list
and the file names of its data sets reach the driver.
"""

from __future__ import annotations

import hashlib
import json
import re
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from clickvault.plans.job import JobParams, run_job
from clickvault.session import fresh_path

_NAME = re.compile(r"([^/]+?)(\.csv)?$")
# the binaryFile source's fixed schema (a stream needs it up front)
BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def run_name(path: str) -> str:
    """Output folder name for an input file: its base name without ``.csv``."""
    return _NAME.search(path.rstrip("/")).group(1)


def _path(spark: SparkSession, path: str):
    """(fs, Path) of a qualified path."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(p)


def data_set(path: str) -> str:
    """The data set that a landed file belongs to: its folder for a part file, else itself."""
    folder, _, name = path.rpartition("/")
    return folder if name.startswith("part-") else path


def output_key(spark: SparkSession, landing_dir: str, path: str) -> str:
    """Output folder of a data set: its path relative to the landing folder, so
    equal names in two folders stay apart; the landing folder's own name if it is the data set."""
    root = _path(spark, landing_dir)[1].toString().rstrip("/")
    return path[len(root) + 1:] if path.startswith(root + "/") else run_name(path)


def _inputs(spark: SparkSession, path: str, wait_s: float) -> list[str]:
    """Name, length and time of the data set's files; a folder must have its ``_SUCCESS``."""
    fs, p = _path(spark, path)
    if fs.getFileStatus(p).isDirectory():
        until = time.monotonic() + wait_s
        while not fs.exists(_path(spark, f"{path}/_SUCCESS")[1]):
            if time.monotonic() > until:
                raise RuntimeError(f"{path} has part files but no _SUCCESS: its writer has not finished")
            time.sleep(min(1.0, wait_s))
    # the data set's own files: a sub-folder is a data set by itself
    return sorted(f"{s.getPath().getName()} {s.getLen()} {s.getModificationTime()}" for s in fs.listStatus(p)
                  if s.isFile() and s.getPath().getName()[0] not in "_.")


def _read_before(spark: SparkSession, marker: str) -> list[str] | None:
    fs, p = _path(spark, marker)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return json.loads(bytes(stream.readAllBytes()))
    finally:
        stream.close()


def _write_marker(spark: SparkSession, marker: str, inputs: list[str]) -> None:
    fs, p = _path(spark, marker)
    out = fs.create(p, True)
    out.write(bytearray(json.dumps(inputs).encode()))
    out.close()


def landing_files(spark: SparkSession, landing_dir: str, pattern: str = "*.csv",
                  max_files_per_trigger: int = 1) -> DataFrame:
    """Streaming frame of newly landed files: ``path``, ``length``."""
    return (spark.readStream.format("binaryFile").schema(BINARY_FILE)
            .option("pathGlobFilter", pattern)
            .option("maxFilesPerTrigger", max_files_per_trigger)
            .option("recursiveFileLookup", "true")
            .load(landing_dir)
            .select("path", "length"))


def start_landing_trigger(spark: SparkSession, landing_dir: str, output_root: str,
                          checkpoint: str | None = None, available_now: bool = True,
                          max_files_per_trigger: int = 1, dedupe: str = "raw", wait_s: float = 60) -> StreamingQuery:
    """Start the stream; each new data set -> ``run_job`` under ``output_root/<relative path>``.

    ``available_now=True`` processes what has landed and stops (a scheduled
    batch); ``False`` keeps watching (checks every 30 s). ``wait_s``: how long
    a batch waits for the ``_SUCCESS`` of a folder of part files.
    """
    checkpoint = checkpoint or fresh_path(spark, "landing-checkpoint")

    def process(batch: DataFrame, epoch_id: int) -> None:
        for path in sorted({data_set(row.path) for row in batch.select("path").distinct().collect()}):
            base = f"{output_root.rstrip('/')}/{output_key(spark, landing_dir, path)}"
            inputs = _inputs(spark, path, wait_s)
            if _read_before(spark, f"{base}/_inputs") != inputs:
                run_id = hashlib.sha256(json.dumps([path, inputs]).encode()).hexdigest()[:32]  # a replay has the same
                run_job(spark, JobParams(base=base, input_path=path, dedupe=dedupe, run_id=run_id))
                _write_marker(spark, f"{base}/_inputs", inputs)

    writer = (landing_files(spark, landing_dir, max_files_per_trigger=max_files_per_trigger)
              .writeStream.foreachBatch(process).option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()

"""Serving tables as one versioned set: all tables change together or not at all.

A refresh writes every given table below a new version folder (concurrent
jobs). Only when all have succeeded is the version published, by one rename
of a small pointer file ``versions/<n>.json`` that names the folder of each
table; a table that was not given keeps the folder of the version before.
Readers resolve the newest pointer once and then read fixed folders, so they
never see tables of two versions; a refresh that fails leaves its unpublished
folder behind and changes nothing. The rename does not replace: of two
refreshes that ran at once one raises and may be run again.

The driver handles names only (one pointer entry a table).
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from clickvault.operators.serving import SERVING_TABLES, nan_to_null, to_serving
from clickvault.schemas import SERVING
from clickvault.sinks.writers import run_concurrently, write_table


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _published(spark: SparkSession, root: str) -> list[int]:
    fs, p = _fs(spark, f"{root}/versions")
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def current(spark: SparkSession, root: str) -> tuple[int, dict[str, str]]:
    """The newest published version and the folder of each of its tables (0 and none before the first)."""
    root = root.rstrip("/")
    versions = _published(spark, root)
    if not versions:
        return 0, {}
    fs, p = _fs(spark, f"{root}/versions/{versions[-1]:012d}.json")
    stream = fs.open(p)
    try:
        return versions[-1], json.loads(bytes(stream.readAllBytes()))
    finally:
        stream.close()


def refresh(spark: SparkSession, root: str, tables: dict[str, DataFrame | None]) -> int:
    """Write and publish a new version; returns its number.

    ``tables``: Gold frames by serving table name; ``None`` or an absent name
    is skipped (its last published data stays). Any failure is raised before
    anything is published.
    """
    unknown = set(tables) - set(SERVING_TABLES)
    if unknown:
        raise ValueError(f"not serving tables: {sorted(unknown)}")
    root = root.rstrip("/")
    before, held = current(spark, root)
    given = {name: df for name, df in tables.items() if df is not None}
    folder = f"{root}/data/{uuid.uuid4().hex}"
    run_concurrently([lambda n=n, df=df: write_table(nan_to_null(to_serving(df, n)), f"{folder}/{n}") for n, df in given.items()])
    held = held | {name: f"{folder}/{name}" for name in given}
    _publish(spark, root, before + 1, held)
    return before + 1


def _publish(spark: SparkSession, root: str, version: int, held: dict[str, str]) -> None:
    fs, tmp = _fs(spark, f"{root}/versions/_{uuid.uuid4().hex}")
    _, final = _fs(spark, f"{root}/versions/{version:012d}.json")
    fs.mkdirs(final.getParent())
    out = fs.create(tmp, False)
    out.write(bytearray(json.dumps(held, sort_keys=True).encode()))
    out.close()
    if fs.exists(final) or not fs.rename(tmp, final):
        raise RuntimeError(f"version {version} of {root} was published by another refresh meanwhile")


def read(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All tables of the newest version: one consistent set."""
    _, held = current(spark, root)
    return {name: spark.read.schema(SERVING[name]).parquet(path) for name, path in held.items()}


def publish_views(spark: SparkSession, root: str, database: str | None = None) -> None:
    """Point catalog views (temporary ones without ``database``) at the newest version, for SQL readers."""
    for name, df in read(spark, root).items():
        if database:
            path = current(spark, root)[1][name]
            spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS SELECT * FROM parquet.`{path}`")
        else:
            df.createOrReplaceTempView(name)

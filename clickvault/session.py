"""Session settings every job relies on.

* session time zone UTC: Silver's date/hour/weekday are defined in UTC;
* ANSI mode stays on (Spark 4 default); bad text is handled with ``try_*``;
* AQE on, so shuffle partitions coalesce and skewed joins split at run time;
* a shared staging folder: ``spark.checkpoint.dir`` as the cluster names it.
  Only when it is unset (local tests) a private folder is created.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

_SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def get_spark(master: str | None = None, app: str = "clickvault",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings above.

    ``master`` defaults to ``$SPARK_MASTER`` or ``local[*]``; on a cluster
    leave it unset and let spark-submit decide.
    """
    builder = SparkSession.builder.appName(app)
    master = master or os.environ.get("SPARK_MASTER")
    if master:
        builder = builder.master(master)
    conf = dict(_SESSION_CONF)
    conf.update({
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    })
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_session(spark)
    return spark


def ensure_session(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session created elsewhere."""
    for k, v in _SESSION_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception as e:  # static or locked conf on a managed cluster
            if k == "spark.sql.session.timeZone" and spark.conf.get(k, None) != v:
                raise RuntimeError(f"{k} must be {v}: dates and hours are defined in it") from e
    return spark


_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A session setting for the queries within; the former one afterwards."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def released_shuffles(spark: SparkSession):
    """Within it, a query's shuffle files are removed when the query ends. Else
    they lie on the local disks until the driver collects the query's plan: a
    chain of large jobs holds the shuffles of all its steps at once."""
    return setting(spark, _RELEASE, "true")


def collect_garbage(spark: SparkSession) -> None:
    """Have the driver look for plans no longer in use, so that the shuffle files
    behind released caches are removed now."""
    sc = _context(spark)
    if sc is not None:
        sc._jvm.System.gc()


def _context(spark: SparkSession):
    """The SparkContext of a classic session (None for a remote session)."""
    try:
        return spark.sparkContext
    except Exception:
        return None


def staging_dir(spark: SparkSession, *parts: str) -> str:
    """A folder in the cluster's shared checkpoint location.

    Reads ``spark.checkpoint.dir`` from the session (or the context's
    checkpoint dir); sets a private one only when neither is set and the
    master is local: on a cluster every machine would see another folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    sc = _context(spark)
    if not base and sc is not None:
        base = sc.getCheckpointDir()
    if not base:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the whole cluster shares")
        base = tempfile.mkdtemp(prefix="clickvault-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", base)
        except Exception:
            pass
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    path = base.rstrip("/")
    for p in parts:
        path = f"{path}/{p}"
    return path


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path under the staging folder."""
    return staging_dir(spark, "clickvault", f"{name}-{uuid.uuid4().hex[:12]}")

"""Session helpers: one place for the settings every job relies on.

Nothing here starts a server: the Spark UI stays off. Lineage is cut in
the shared folder named by ``spark.checkpoint.dir``; a folder is only
chosen here when the session has none and runs in local mode (tests).
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app_name: str = "starlattice",
                shuffle_partitions: int | None = None,
                conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(SESSION_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and staged tables.

    Read from the session (``spark.checkpoint.dir`` / the context's
    checkpoint dir). Only a local-mode session without one gets a fresh
    temporary folder; a cluster session without one is an error, since a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="starlattice-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the checkpoint root."""
    return f"{checkpoint_root(spark).rstrip('/')}/starlattice/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint root and read it back.

    Cuts the lineage, so a lost executor re-reads the written files instead
    of recomputing the whole plan, and pins values of position-dependent
    expressions (partition ids, positions) once and for all. ``options`` are the writer's.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with job_label(spark, f"materialize {name}"):
        df.write.mode("overwrite").options(**options).parquet(path)
    return spark.read.parquet(path)


@contextmanager
def settings(spark: SparkSession, **conf):
    """Session settings for the writes inside the block ('.' given as '__'), as they were before afterwards."""
    names = {k.replace("__", "."): str(v) for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that nothing reads any more."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def job_label(spark: SparkSession, label: str):
    """Name the Spark jobs started inside the block (shown in history/event log)."""
    sc = spark.sparkContext
    previous = sc.getLocalProperty("spark.job.description")
    sc.setJobDescription(label)
    try:
        yield
    finally:
        sc.setJobDescription(previous)

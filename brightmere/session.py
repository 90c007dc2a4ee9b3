"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that change results or that large skewed inputs rely on. Everything
# else (executors, memory, shuffle partition count) belongs to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(app: str = "brightmere", master: str | None = None, **conf: str) -> SparkSession:
    """Build a session with the library's defaults; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, taken from ``spark.checkpoint.dir``.

    A local session without the setting gets a temporary folder of its own. On a
    cluster a missing setting is an error: a machine-local folder would be lost
    with its executor.
    """
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="brightmere-"))
    return context.getCheckpointDir().rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is ever written twice to one path."""
    return f"{shared_folder(spark)}/brightmere/{label}-{uuid.uuid4().hex}"


def scratch_name(label: str) -> str:
    """A fresh catalog name for a table or view."""
    return f"{label}_{uuid.uuid4().hex[:12]}"


def remove_folders(spark: SparkSession, paths: list[str]) -> None:
    """Delete folders that a run has staged and no longer reads."""
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)

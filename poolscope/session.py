"""Session construction and the shared scratch location."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Methods above 8000 bytes of bytecode are never compiled by the JVM. Documents are wide, so
# let such stages use split expressions instead of one method that stays interpreted.
CODEGEN_SETTINGS = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def build_session(master: str | None = None, app_name: str = "poolscope", **conf: str) -> SparkSession:
    """A session with the settings the operators are written for; ``conf`` overrides them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **CODEGEN_SETTINGS,
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings for wide documents to a session made elsewhere."""
    for key, value in CODEGEN_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    return _local_dir()


@functools.cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="poolscope-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system that Spark resolves it on."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def qualified(spark: SparkSession, path: str) -> str:
    """The path as a URI of the file system that Spark resolves it on, for readers and writers other than Spark's."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    full = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()
    return "file://" + full.removeprefix("file:") if full.startswith("file:/") and not full.startswith("file://") else full

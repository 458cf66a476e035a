"""Session construction for tests and the benchmark, and the shared folder.

Library code never builds a session: the caller supplies it. ``build_session``
exists for tests, the benchmark and local runs.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "cabmeter", extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    """One JVM without executors; ``local-cluster`` is a cluster."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder every executor can read and write.

    It is taken from the session's ``spark.checkpoint.dir`` (or the context's
    checkpoint directory). Only a local-mode session without one gets a fresh
    folder of its own; on a cluster an unset value is an error, since a
    machine-local folder would be invisible to the other executors.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    context_dir = spark.sparkContext.getCheckpointDir()
    if base and not context_dir:
        # Set as a runtime conf only: give the context the same folder so
        # DataFrame.checkpoint() writes there too.
        spark.sparkContext.setCheckpointDir(base)
    if not base:
        base = context_dir
    if not base:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a folder shared by the cluster"
            )
        base = tempfile.mkdtemp(prefix="cabmeter-")
        spark.sparkContext.setCheckpointDir(base)
        spark.conf.set("spark.checkpoint.dir", base)
    return os.path.join(base, *parts) if parts else base


def fresh_dir(spark: SparkSession, kind: str) -> str:
    """A new, unique sub-folder of the application's part of the shared folder
    (outputs, models, streams). ``drop_scratch`` deletes that part."""
    return shared_dir(spark, "cabmeter", spark.sparkContext.applicationId, kind, uuid.uuid4().hex)


def _path(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists in whatever file system it names."""
    jvm_path, fs = _path(spark, path)
    return fs.exists(jvm_path)


def drop_scratch(spark: SparkSession) -> None:
    """Delete what this application's queries keep in the shared folder. Call
    it when the results that read from there have been consumed."""
    jvm_path, fs = _path(spark, shared_dir(spark, "cabmeter", spark.sparkContext.applicationId))
    fs.delete(jvm_path, True)

"""Spark session and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings a job needs regardless of cluster size; executor sizing and
# shuffle partition counts belong to the cluster's own configuration.
JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tessera") -> SparkSession:
    """A local-mode session for tests and the bench (UI off)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # No Python call-site capture on every API call (error context only).
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # One node, small inputs: let AQE keep several post-shuffle partitions
        # per core instead of merging everything into one task (cluster
        # sessions keep the default sizes).
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64KB")
    )
    for k, v in JOB_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_job_conf(spark: SparkSession) -> None:
    """Session-level SQL settings the operators rely on (time zone, AQE)."""
    for k, v in JOB_CONF.items():
        if k == "spark.sql.ansi.enabled":
            continue
        spark.conf.set(k, v)


@contextmanager
def session_conf(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """SQL settings for as long as the block runs; a stream keeps those it was started under."""
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Read from the session, and registered as the checkpoint folder if the
    context has none yet. Only in local mode, where driver and executor are one
    process, a scratch folder is created and registered if it is unset; on a
    cluster an unset folder is an error, as executors share no local folder.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(path)
        return path
    path = sc.getCheckpointDir()
    if path:
        return path
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="tessera-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder for one job's outputs."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")

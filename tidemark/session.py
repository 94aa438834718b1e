"""Session defaults and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# All temporal conversions are defined in UTC.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


# Bytes a shuffle partition should hold.
SHUFFLE_TARGET = 256 << 20


def scale_conf(input_bytes: int, cores: int = 1) -> dict[str, str]:
    """Shuffle settings for an input size. Adaptive execution joins small partitions, but cannot split large ones."""
    partitions = max(cores * 2, -(-input_bytes // SHUFFLE_TARGET), 8)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(SHUFFLE_TARGET),
        "spark.sql.files.maxPartitionBytes": str(SHUFFLE_TARGET),
    }


def get_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, from ``spark.checkpoint.dir``.

    A temporary folder is used only in local mode with the setting unset; on a
    cluster a folder of one machine would be lost with that machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return tempfile.mkdtemp(prefix="tidemark-")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/tidemark/{label}-{uuid.uuid4().hex}"

"""Session settings and scratch locations."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Pin the two session settings results depend on.

    Sizing (shuffle partitions, split size, memory) stays with the cluster.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.ansi.enabled", "true")
    return spark


def local_session(app: str, cpus: str = "8") -> SparkSession:
    """Single-JVM session for tests and the benchmark."""
    partitions = "8" if cpus == "*" else cpus
    return configure(
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        .getOrCreate()
    )


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared folder the cluster names.

    Only a local master may fall back to a machine-local folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return f"{root.rstrip('/')}/layerkit/{label}-{uuid.uuid4().hex}"


def scratch_schema(spark: SparkSession, label: str) -> str:
    """A new catalog schema whose tables live in a scratch folder."""
    name = f"lk_{label}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE SCHEMA {name} LOCATION '{scratch_dir(spark, label)}'")
    return name

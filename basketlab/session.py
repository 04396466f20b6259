"""Session helpers: a local session for tests and benches, and stages written to the shared folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "basketlab") -> SparkSession:
    """Local session for tests and benches (UI off, AQE on, UTC)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("BASKETLAB_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only a local-mode session without one (tests) gets a scratch folder; a
    cluster session without one is an error, never a machine-local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster (HDFS / object store)")
        configured = tempfile.mkdtemp(prefix="basketlab-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it back.

    One pass over the input, lineage cut, survives executor loss, and the read
    side carries exact size statistics for AQE's join choices.
    """
    spark = df.sparkSession
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/basketlab-{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)

"""Publishing several outputs as one (D21): readers see a run whole or not at all.

Every run writes its outputs under a folder of its own; the last step appends
one row to the manifest, which Spark commits as a single file. Readers follow
the manifest's newest row, so a run that fails between two outputs changes
nothing, and all outputs of a reader belong to one run.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST_SCHEMA = "seq long, run string, outputs map<string,string>"


def _manifest(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(MANIFEST_SCHEMA).json(f"{root}/manifest")


def _newest(spark: SparkSession, root: str):
    """The newest row of the manifest, or None where nothing was published yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/manifest")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return None
    newest = _manifest(spark, root).agg(F.max(F.struct("seq", "run", F.map_entries("outputs").alias("outputs"))).alias("m")).first()["m"]
    return newest


class Run:
    """One run's outputs: written one by one, visible together after :meth:`commit`."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.name = uuid.uuid4().hex
        self.paths: dict[str, str] = {}

    def write(self, name: str, df: DataFrame) -> DataFrame:
        """``df`` written under this run and read back."""
        path = f"{self.root}/{name}/{self.name}"
        df.write.mode("errorifexists").parquet(path)
        self.paths[name] = path
        return self.spark.read.parquet(path)

    def commit(self) -> None:
        before = _newest(self.spark, self.root)
        pairs = [x for k, v in self.paths.items() for x in (F.lit(k), F.lit(v))]
        row = self.spark.range(1, numPartitions=1).select(
            F.lit((before["seq"] if before else 0) + 1).cast("long").alias("seq"), F.lit(self.name).alias("run"), F.create_map(*pairs).alias("outputs")
        )
        row.write.mode("append").json(f"{self.root}/manifest")


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Output ``name`` of the newest committed run."""
    newest = _newest(spark, root.rstrip("/"))
    paths = {e["key"]: e["value"] for e in newest["outputs"]} if newest else {}
    if name not in paths:
        raise ValueError(f"{name} was never published under {root}")
    return spark.read.parquet(paths[name])

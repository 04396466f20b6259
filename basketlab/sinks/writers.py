"""Sinks: tables, a single headered CSV for dashboards, dated snapshots (K1, K2, K3)."""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def write_table(
    df: DataFrame,
    target: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    bucket_by: str | None = None,
    buckets: int | None = None,
    location: str | None = None,
) -> None:
    """Overwrite a catalog table (plain name) or a path (anything with a ``/``).

    ``location`` keeps a catalog table's files in that folder instead of the warehouse.

    ``bucket_by`` + ``buckets`` (catalog tables only) store the table hash-
    bucketed, so later aggregations and joins keyed on that column (plus any
    other keys) read it without a shuffle.
    """
    w = df.write.mode(mode).format(fmt)
    if "/" in target:
        w.save(target)
        return
    if bucket_by and buckets:
        w = w.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    if location:
        w = w.option("path", location)
    w.saveAsTable(target)


def write_csv(df: DataFrame, path: str, single_file: bool = False, mode: str = "overwrite") -> None:
    """Headered CSV folder, one part file per task.

    ``single_file`` leaves one file in the folder: the part files are written in
    parallel and joined by the file system in their order, under one header. On
    file systems that cannot join files (object stores) one task writes it.
    Array columns are rendered as ``[a, b]`` text since CSV has no array type.
    """
    out = df.select(
        [
            F.concat(F.lit("["), F.array_join(F.col(c).cast("array<string>"), ", "), F.lit("]")).alias(c)
            if t.startswith("array")
            else F.col(c)
            for c, t in df.dtypes
        ]
    )
    if single_file and _joins_files(df.sparkSession, path):
        _write_joined(out, path.rstrip("/"), mode)
        return
    if single_file:
        out = out.coalesce(1)
    out.write.mode(mode).option("header", True).csv(path)


def _file_system(spark: SparkSession, path: str):
    """(file system, path) as the JVM sees them; local files without checksum side files."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return (fs.getRawFileSystem() if fs.getUri().getScheme() == "file" else fs), at


def _joins_files(spark: SparkSession, path: str) -> bool:
    fs, at = _file_system(spark, path)
    return fs.getUri().getScheme() == "file" or fs.hasPathCapability(at, "fs.capability.paths.concat")


def _write_joined(out: DataFrame, path: str, mode: str) -> None:
    """Header and parts in a folder beside ``path``, joined there and moved to ``path`` as a whole."""
    spark = out.sparkSession
    fs, target = _file_system(spark, path)
    if fs.exists(target) and mode != "overwrite":
        raise FileExistsError(path)
    beside = f"{path}.joining-{uuid.uuid4().hex}"
    new = lambda name: spark._jvm.org.apache.hadoop.fs.Path(f"{beside}/{name}")
    try:
        out.limit(0).coalesce(1).write.option("header", True).csv(f"{beside}/header")
        out.write.csv(f"{beside}/parts")

        def files(name: str) -> list:
            found = [s for s in fs.listStatus(new(name)) if s.getPath().getName().startswith("part-") and s.getLen()]
            return [s.getPath() for s in sorted(found, key=lambda s: (int(s.getPath().getName().split("-")[1]), s.getPath().getName()))]

        fs.mkdirs(new("whole"))
        whole, (header,), parts = new("whole/part-00000.csv"), files("header"), files("parts")
        if fs.getUri().getScheme() == "file":  # builds the file anew
            _concat(spark, fs, whole, [header, *parts])
        else:  # moves the parts' blocks behind the header's
            fs.rename(header, whole)
            if parts:
                _concat(spark, fs, whole, parts)
        fs.create(new("whole/_SUCCESS")).close()
        fs.delete(target, True)
        if not fs.rename(new("whole"), target):
            raise OSError(f"could not move the joined file to {path}")
    finally:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(beside), True)


def _concat(spark: SparkSession, fs, target, sources: list) -> None:
    array = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Path, len(sources))
    for i, s in enumerate(sources):
        array[i] = s
    fs.concat(target, array)


def read_in_order(spark: SparkSession, path: str, position: str = "position") -> DataFrame:
    """A Parquet folder written in a global order, with each row's place 1, 2, ... in it.

    A range-ordered write numbers its part files by range, so the place is that
    within the file plus the sizes of the files before (one row a file).
    """
    at = F.col("_metadata.file_name")
    rows = spark.read.parquet(path).select("*", at.alias("_file"), (F.col("_metadata.row_index") + 1).alias("_row"))
    sizes = rows.groupBy("_file").agg(F.count("*").alias("_n"))
    before = sizes.select("_file", (F.sum("_n").over(Window.orderBy("_file")) - F.col("_n")).alias("_before"))
    return rows.join(before, "_file").withColumn(position, F.col("_before") + F.col("_row")).drop("_file", "_row", "_before")


def write_snapshot(
    df: DataFrame,
    path: str,
    run_date: str | _dt.date | None = None,
    fmt: str = "parquet",
    column: str = "run_date",
) -> None:
    """Append-safe dated archive: one partition per run date, rewritten only for that date.

    Re-running a day replaces that day's partition and leaves the others
    (dynamic partition overwrite), so a daily job is idempotent.
    """
    day = run_date or _dt.date.today()
    if isinstance(day, str):
        day = _dt.date.fromisoformat(day)
    spark = df.sparkSession
    prev = spark.conf.get("spark.sql.sources.partitionOverwriteMode", "static")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        (
            df.withColumn(column, F.lit(day.isoformat()))
            .write.mode("overwrite")
            .partitionBy(column)
            .format(fmt)
            .option("header", True)
            .save(path)
        )
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", prev)

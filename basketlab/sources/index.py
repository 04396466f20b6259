"""Market index and company dictionary read from headered CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """Headered CSV with every column kept as text (no inference pass over the data)."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


def index_series(
    raw: DataFrame,
    date_col: str = "Date",
    level_col: str = "Close",
    pattern: str = "M/d/yyyy",
) -> DataFrame:
    """``(date date, level double)`` from the text columns of the index file.

    Rows with a null in any column of the file or an unparseable date are
    dropped (the original drops incomplete rows before projecting, so an
    unrelated empty column also removes a row). A present but non-numeric
    level keeps its date with a null level, as the original's implicit
    text-to-number cast does: that day's index return is 0 and the next
    day's is missing. A date given several times counts once, with its highest
    level, so every later join is one row per date.
    """
    parsed = raw.withColumn("_date", F.try_to_date(F.col(date_col).cast("string"), pattern))
    parsed = parsed.dropna()
    return parsed.groupBy(F.col("_date").alias("date")).agg(
        F.max(F.col(level_col).cast("string").try_cast("double")).alias("level")
    )


def read_companies(spark: SparkSession, path: str) -> DataFrame:
    """Company dictionary: ``symbol`` plus any other columns, all text."""
    return read_csv_text(spark, path)

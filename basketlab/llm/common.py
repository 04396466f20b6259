"""Helpers shared by the operators: tables, the shared folder, column idioms."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words in the contracts: space and U+0009-U+000D.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all executors share.

    Only a session without that setting in local mode (tests: one machine, one
    process) gets a temporary folder; elsewhere the missing setting is an error.
    """
    sc = spark.sparkContext
    named = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="llm-shared-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(named)
    return (sc.getCheckpointDir() or named).rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: lineage cut, sizes known."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_row(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct, so that an operator's own columns cannot touch them."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where ``body`` uses it inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column, separators: str = SPACE) -> Column:
    """Words of a whole text in order; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separators), "")


def windows(items: Column, n: Column, width: int, make: Callable[[Column], Column]) -> Column:
    """``make(slice)`` for each run of ``width`` neighbouring items; none if there are fewer."""
    full = F.transform(F.sequence(F.lit(0), F.greatest(n - width, F.lit(0))), lambda i: make(F.slice(items, i + 1, width)))
    return F.when(n >= width, full)


def count_of(text: Column, characters: str) -> Column:
    """How many characters of ``text`` are among ``characters``."""
    return F.char_length(text) - F.char_length(F.translate(text, characters, ""))


def bounded_sample(df: DataFrame, most: int, *order: str, distinct: bool = False) -> DataFrame:
    """At most ``most`` rows of ``df``, chosen by the hash in ``order[0]``: the same rows for any partitioning.

    A count comes first; of a larger table only between about two and four times
    ``most`` rows, by the hash alone, take part in the ordering, so what is
    gathered does not grow.
    ``distinct``: rows of one hash are copies and count as one (else they pass or go together).
    """
    h = order[0]
    step = (df.select(h).distinct() if distinct else df).count() // (2 * most)
    thin = df.where(F.pmod(F.col(h), F.lit(step)) == 0) if step > 1 else df
    if distinct:
        thin = thin.groupBy(h).agg(*[F.min(c).alias(c) for c in df.columns if c != h])
    return thin.orderBy(*order).limit(most)

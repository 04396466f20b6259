"""Price histories: nested per-ticker documents -> flat stocks table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

HISTORY_FIELD = "historical"


def read_price_documents(
    spark: SparkSession, path: str, schema: StructType | str | None = None, multi_line: bool = True
) -> DataFrame:
    """Scan a folder/glob of multi-line JSON documents, one per ticker.

    Without ``schema`` the fields are inferred, so unknown record fields pass
    through to the flat table. Documents without a history (error messages,
    empty objects) read as a null ``historical`` and produce no rows in
    :func:`flatten_history`. Multi-line JSON is not splittable: each file is
    one task, and the number of files sets the scan parallelism. Documents of
    one line each (``multi_line=False``) split like any text.
    """
    reader = spark.read.option("multiLine", multi_line)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_price_records(spark: SparkSession, path: str, history: str = HISTORY_FIELD) -> DataFrame:
    """The flat stocks table straight from a folder of multi-line documents, whatever single files hold.

    Each file is one document, parsed on its own, so no file can change how the
    others are read. Unreadable or empty files, documents without a history and
    histories that are no arrays give no rows; a value of another type is cast
    (``"12.5"`` is a price) and null where it cannot be. Fields of the records
    beyond ``date``, ``adjClose`` and ``label`` pass through with the type that
    all records have in common, text where they have none.
    """
    files = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True).select(F.try_parse_json("value").alias("doc"))
    docs = files.select(
        F.try_variant_get("doc", "$.symbol", "string").alias("symbol"), F.try_variant_get("doc", f"$.{history}", "array<variant>").alias("records")
    )
    records = docs.select("symbol", F.explode("records").alias("rec"))
    common = records.agg(F.schema_of_variant_agg("rec")).first()[0]  # one line of text
    known = {"date": "string", "adjClose": "double", "label": "string"}
    known |= {k: t for k, t in _fields(common or "").items() if k not in known}
    return records.select("symbol", *[F.try_variant_get("rec", f"$['{k}']", t).alias(k) for k, t in known.items() if "'" not in k])


def _fields(schema: str) -> dict[str, str]:
    """Fields of ``OBJECT<...>`` with their types; what is not one type throughout is text."""
    if not schema.startswith("OBJECT<"):
        return {}
    text = schema.replace("OBJECT<", "STRUCT<").replace("VOID", "STRING").replace("VARIANT", "STRING")
    return {f.name: f.dataType.simpleString() for f in _parse_datatype_string(text).fields}


def flatten_history(docs: DataFrame, history: str = HISTORY_FIELD) -> DataFrame:
    """One row per (ticker, record): ``symbol`` plus every field of the records.

    ``explode`` drops null or empty histories. ``adjClose`` is cast to double
    because inference types all-whole prices as bigint.
    """
    if history not in docs.columns:
        return docs.sparkSession.createDataFrame(
            [], "symbol string, date string, adjClose double, label string"
        )
    flat = docs.select("symbol", F.explode(history).alias("_rec")).select("symbol", "_rec.*")
    if "adjClose" in flat.columns:
        flat = flat.withColumn("adjClose", F.col("adjClose").cast("double"))
    return flat


def read_stocks(spark: SparkSession, source: str) -> DataFrame:
    """Stocks table by catalog name or by parquet path."""
    if "/" in source or source.endswith(".parquet"):
        return spark.read.parquet(source)
    return spark.table(source)


def parse_price_dates(stocks: DataFrame, pattern: str = "yyyy-MM-dd") -> DataFrame:
    """Replace the text ``date`` column by a date; unparseable text becomes null."""
    if dict(stocks.dtypes).get("date") == "date":
        return stocks
    return stocks.withColumn("date", F.try_to_date(F.col("date").cast("string"), pattern))

import pytest

DOCS = "doc_id long, text string"


@pytest.fixture(scope="session")
def make(spark):
    """Rows as a DataFrame over three partitions; with ``extra`` columns whose names clash with results."""

    def build(rows, schema=DOCS, clash=()):
        df = spark.createDataFrame(rows, schema).repartition(3)
        for c in clash:
            from pyspark.sql import functions as F

            df = df.withColumn(c, F.lit("old"))
        return df

    return build

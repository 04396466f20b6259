import datetime as dt

from pyspark.sql import functions as F

SF_SMALL = "/root/testdata/sf0.001"
D0 = dt.date(2024, 1, 1)


def day(i):
    return D0 + dt.timedelta(days=i)


def stocks_df(spark, rows):
    """rows: (symbol, day_index, price or None) -> flat stocks table with text dates."""
    data = [(s, day(i).isoformat(), None if p is None else float(p), f"{s} {i}") for s, i, p in rows]
    return spark.createDataFrame(data, "symbol string, date string, adjClose double, label string")


def index_df(spark, levels):
    """levels: {day_index: level} -> (date, level)."""
    data = [(day(i), float(v)) for i, v in sorted(levels.items())]
    return spark.createDataFrame(data, "date date, level double")


def by_date(df, col="ret", symbol=None):
    if symbol is not None:
        df = df.where(F.col("symbol") == symbol)
    return {r["date"]: r[col] for r in df.collect()}

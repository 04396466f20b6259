from basketlab.sources.index import index_series, read_companies, read_csv_text
from basketlab.sources.prices import (
    flatten_history,
    parse_price_dates,
    read_price_documents,
    read_stocks,
)

__all__ = [
    "flatten_history",
    "index_series",
    "parse_price_dates",
    "read_companies",
    "read_csv_text",
    "read_price_documents",
    "read_stocks",
]

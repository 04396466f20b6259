"""Pipeline parameters. Defaults are the values of the original daily batch."""

from __future__ import annotations

from dataclasses import dataclass

# The ticker universe of the original batch, in its own order.
DEFAULT_UNIVERSE = (
    "AAPL", "ABBV", "ABT", "ADBE", "ADP", "AMGN", "AMT", "AMZN", "AROW", "ARTNA",
    "AXP", "AZN", "BA", "BABA", "BAC", "BCAL", "BHP", "BKNG", "BTI", "CAT", "CECO",
    "CHEF", "CL", "CMRX", "COCO", "CRM", "CRML", "CSCO", "CTOS", "CVX", "DEO", "DIS",
    "ELLO", "EQIX", "ETN", "FAT", "GCMG", "GE", "GOOGL", "GRC", "GS", "GWRS", "HIMX",
    "HIPO", "HON", "IBM", "ICHR", "ISRG", "JNJ", "JPM", "KLG", "KMB", "KO", "LIN",
    "LLY", "LMT", "MA", "MCD", "MDLZ", "META", "MS", "MSFT", "MXL", "NFLX", "NKE",
    "NSPR", "NTES", "NVDA", "ORCL", "PCYO", "PDD", "PFE", "PG", "PLCE", "PM", "PNNT",
    "PNST", "RIO", "SAP", "SIRI", "SNY", "SPOT", "SRG", "SUP", "TCI", "TH", "TJX",
    "TM", "TSLA", "TSM", "UAN", "UL", "UNH", "UNP", "V", "VZ", "WFC", "WMG", "WMT",
    "YTRA",
)


@dataclass(frozen=True)
class PipelineConfig:
    """Every threshold of the pipeline.

    ``universe=None`` means "every symbol present in the prices"; a list keeps
    the original semantics of a fixed ticker list (a listed ticker without data
    empties the complete-case panel).
    """

    universe: tuple[str, ...] | None = None
    # Rounding points and thresholds of the original batch.
    return_decimals: int = 6
    corr_decimals: int = 2
    mean_decimals: int = 6
    beta_decimals: int = 2
    weight_decimals: int = 2
    report_decimals: int = 2
    corr_lo: float = 0.5
    corr_hi: float = 0.99
    min_size: int = 6  # 5 < n
    max_size: int = 10  # n <= 10
    periods_per_year: int = 250
    high_beta_threshold: float = 1.0
    index_date_pattern: str = "M/d/yyyy"
    price_date_pattern: str = "yyyy-MM-dd"


# Parameters used by the registered queries on the synthetic test tables: the
# default 0.5 lower bound leaves almost no correlated pairs there.
TEST_CONFIG = PipelineConfig(corr_lo=0.2, corr_hi=0.99)

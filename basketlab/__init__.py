"""basketlab: correlated-basket portfolio analytics expressed as Spark DataFrame plans.

Input: per-ticker price histories and a market index. Output: baskets of
correlated stocks with long-only minimum-variance weights, expected return,
investment amount, volatility label and holdings.

    from basketlab import Analysis, PipelineConfig, run_pipeline
"""

from basketlab.config import PipelineConfig
from basketlab.plans.analysis import Analysis
from basketlab.plans.pipeline import run_pipeline, upload_prices

__all__ = ["Analysis", "PipelineConfig", "run_pipeline", "upload_prices"]

from basketlab.operators.baskets import (
    basket_arrays,
    basket_universe,
    build_baskets,
    correlated_peers,
    equal_weights,
)
from basketlab.operators.metrics import (
    portfolio_return,
    portfolio_risk,
    portfolio_summary,
    volatility_label,
)
from basketlab.operators.panel import (
    aligned_returns,
    calendar,
    dropped_dates,
    latest_close,
    pivot_panel,
    price_panel,
    returns_wide,
    universe_frame,
)
from basketlab.operators.report import holdings, portfolio_detail
from basketlab.operators.stats import (
    betas,
    correlation_half,
    correlation_matrix,
    correlation_wide,
    covariance,
    mean_returns,
    member_stats,
    pair_moments,
)
from basketlab.operators.weights import (
    min_variance_qp,
    min_variance_weights,
)

__all__ = [
    "aligned_returns",
    "basket_arrays",
    "basket_universe",
    "betas",
    "build_baskets",
    "calendar",
    "correlated_peers",
    "correlation_matrix",
    "correlation_wide",
    "covariance",
    "dropped_dates",
    "equal_weights",
    "holdings",
    "latest_close",
    "mean_returns",
    "member_stats",
    "min_variance_qp",
    "min_variance_weights",
    "pair_moments",
    "pivot_panel",
    "portfolio_detail",
    "portfolio_return",
    "portfolio_risk",
    "portfolio_summary",
    "price_panel",
    "returns_wide",
    "universe_frame",
    "volatility_label",
]

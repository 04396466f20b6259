"""The whole analysis as one lazy DataFrame graph.

``Analysis`` wires the operators D2-D20 together; a stage is built when it is
first asked for, so a caller that only asks for ``betas`` plans only the
stages betas depends on, and Catalyst prunes the rest. Building is not always
lazy: numbering the baskets writes their seeds, and with ``materialize_stages``
the reused stages are written to the cluster's ``spark.checkpoint.dir`` and
read back as they are built, cutting their lineage.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame

from basketlab.config import PipelineConfig
from basketlab.operators import baskets as B
from basketlab.operators import metrics as M
from basketlab.operators import panel as P
from basketlab.operators import report as R
from basketlab.operators import stats as S
from basketlab.operators import weights as W
from basketlab.sources.index import index_series
from basketlab.sources.prices import parse_price_dates
from basketlab.session import materialize


@dataclass
class Analysis:
    """Inputs: the flat stocks table, the index file as text, the company dictionary."""

    stocks: DataFrame
    index_raw: DataFrame
    companies: DataFrame | None = None
    config: PipelineConfig = field(default_factory=PipelineConfig)
    optimal: bool = True
    # Write the small reused stages (panel, returns, baskets, summary) to the
    # shared checkpoint folder: each is computed once and its lineage cut, and
    # the raw stocks table is aggregated once.
    materialize_stages: bool = False
    # optional ordered universe as a DataFrame ``(symbol, upos)``; overrides
    # ``config.universe`` when given
    universe_df: DataFrame | None = None

    def _keep(self, df: DataFrame, name: str) -> DataFrame:
        return materialize(df, name) if self.materialize_stages else df

    # -- panel and returns -------------------------------------------------
    @cached_property
    def panel(self) -> DataFrame:
        # the only stage that reads the raw stocks table: aggregate it once
        return self._keep(P.price_panel(self.stocks, self.config.price_date_pattern), "panel")

    @cached_property
    def index(self) -> DataFrame:
        return self._keep(index_series(self.index_raw, pattern=self.config.index_date_pattern), "index")

    @property
    def _universe_spec(self):
        return self.universe_df if self.universe_df is not None else self.config.universe

    @cached_property
    def universe(self) -> DataFrame:
        return P.universe_frame(self.panel, self._universe_spec)

    @cached_property
    def returns(self) -> DataFrame:
        r = P.aligned_returns(self.panel, self.index, self._universe_spec, self.config.return_decimals)
        return self._keep(r, "returns")

    # -- correlation and baskets -------------------------------------------
    @cached_property
    def corr_half(self) -> DataFrame:
        c = self.config
        return S.correlation_half(self.returns, c.corr_decimals, c.return_decimals)

    @cached_property
    def corr(self) -> DataFrame:
        return S.mirror(self.corr_half, "corr")

    @cached_property
    def peers(self) -> DataFrame:
        c = self.config
        half = S.correlation_half_in_range(self.returns, c.corr_lo, c.corr_hi, c.corr_decimals, c.return_decimals)
        return self._keep(B.peers_of_half(half, c.corr_lo, c.corr_hi), "peers")

    @cached_property
    def baskets(self) -> DataFrame:
        c = self.config
        return self._keep(B.build_baskets(self.peers, self.universe, c.min_size, c.max_size), "baskets")

    @cached_property
    def members(self) -> DataFrame:
        return B.basket_universe(self.baskets)

    # -- per-member statistics ---------------------------------------------
    @cached_property
    def member_stats(self) -> DataFrame:
        c = self.config
        return S.member_stats(self.returns, c.mean_decimals, c.beta_decimals, c.return_decimals, self.members)

    @cached_property
    def means(self) -> DataFrame:
        return self.member_stats.select("symbol", "mean")

    @cached_property
    def cov(self) -> DataFrame:
        return S.covariance(self.returns, self.config.return_decimals, self.members)

    @cached_property
    def basket_cov(self) -> DataFrame:
        """Covariances of the pairs that share a basket, ``symbol_a <= symbol_b``."""
        return S.pair_covariance(self.returns, W.basket_pairs(self.baskets), self.config.return_decimals)

    @cached_property
    def betas(self) -> DataFrame:
        return self.member_stats.select("symbol", "beta")

    @cached_property
    def latest(self) -> DataFrame:
        return P.latest_close(self.panel, self.members)

    # -- weights and report -------------------------------------------------
    @cached_property
    def equal_weights(self) -> DataFrame:
        return B.equal_weights(self.baskets, self.config.weight_decimals)

    @cached_property
    def optimal_weights(self) -> DataFrame:
        c = self.config
        return W.min_variance_weights(self.baskets, self.basket_cov, c.weight_decimals)

    @cached_property
    def weights(self) -> DataFrame:
        return self.optimal_weights if self.optimal else self.equal_weights

    @cached_property
    def risk(self) -> DataFrame:
        c = self.config
        return M.portfolio_risk(self.weights, self.returns, c.periods_per_year, c.weight_decimals, c.return_decimals)

    @cached_property
    def expected_return(self) -> DataFrame:
        c = self.config
        return M.portfolio_return(
            self.weights, self.means, c.periods_per_year, c.weight_decimals, c.mean_decimals, c.report_decimals
        )

    @cached_property
    def summary(self) -> DataFrame:
        c = self.config
        s = M.portfolio_summary(
            self.weights,
            self.member_stats,
            self.latest,
            c.periods_per_year,
            c.weight_decimals,
            c.mean_decimals,
            c.report_decimals,
            c.high_beta_threshold,
        )
        return self._keep(s, "summary")

    @cached_property
    def holdings(self) -> DataFrame:
        if self.companies is None:
            raise ValueError("holdings need a company dictionary")
        return R.holdings(self.summary, self.companies)

    @cached_property
    def stock_history(self) -> DataFrame:
        return parse_price_dates(self.stocks, self.config.price_date_pattern)

    @cached_property
    def detail(self) -> DataFrame:
        return R.portfolio_detail(self.holdings, self.stock_history)

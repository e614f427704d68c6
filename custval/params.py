"""Run parameters: fixed dates and model constants, never ``current_date()``."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Params:
    as_of: dt.date = dt.date(2001, 8, 1)          # "today" of the run
    order_floor: dt.date = dt.date(1995, 7, 1)    # earliest first-order date kept
    window_days: int = 400                        # repeat window of the hazard label
    holdout_days: int = 365                       # train cutoff = as_of - holdout_days
    # channel exclusions (consumer scope)
    hazard_excluded: tuple = ("Event", "Corporate Sales")
    aov_excluded: tuple = ("Event", "Corporate Sales", "Wholesale")
    # order-value model
    mix_shrink_m: float = 2.0
    predictor: str = "mean"                       # "mean" (smearing) or "median" (RT = 1)
    # repeat curve / projection
    max_bucket: int = 8
    horizon: int = 15
    tier_high: float = 0.7
    tier_medium: float = 0.5
    high_churn_cutoff: float = 0.75
    flat_aov: float = 310.23
    split_seed: str = "seed_1"
    test_share: float = 0.20
    val_share: float = 0.20
    sweep_m: tuple = field(default=(1, 2, 3, 5, 10))
    backtest_years: tuple = (1998, 1999)         # calendar years of the projection backtest
    backtest_stages: tuple = (1, 2, 3, 4, 5)
    sample_seed: str = "sample_42"
    sample_size: int = 100

    @property
    def maturity_cutoff(self) -> dt.date:
        return self.as_of - dt.timedelta(days=self.window_days)

    @property
    def join_ceiling(self) -> dt.date:
        return self.maturity_cutoff

    @property
    def train_cutoff(self) -> dt.date:
        return self.as_of - dt.timedelta(days=self.holdout_days)

    @property
    def test_end(self) -> dt.date:
        return self.as_of


DEFAULT = Params()

"""Run parameters shared by every step."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Params:
    """Business parameters of the pipeline.

    The defaults are the values the original scripts hard-code.
    """

    # label: churned when Recency is strictly greater than this many days
    churn_days: int = 120
    # high-value customers: Monetary at or above this quantile
    hv_quantile: float = 0.8
    # look-back windows (days before the analysis date) of the activity ratios
    windows: tuple[int, ...] = (30, 60, 90)
    # campaign economics
    campaign_cost: float = 5.0
    success_rate: float = 0.25
    roi_thresholds: tuple[float, ...] = (0.5, 0.6, 0.7, 0.8)
    # threshold sweep 0.40, 0.45, ... 0.85 expressed in hundredths
    sweep_from: int = 40
    sweep_to: int = 85
    sweep_step: int = 5
    sweep_min_targets: int = 10
    # high-risk cut on the churn probability
    high_risk_probability: float = 0.7
    # train / validation / test split
    seed: int = 42
    split_fractions: tuple[float, float, float] = (0.70, 0.15, 0.15)
    cv_folds: int = 5
    # segments treated as "high risk" by the RFM step
    high_risk_segments: tuple[str, ...] = field(
        default=("At Risk", "Cannot Lose Them"))
    # optional country scope (None = every country)
    country: str | None = None

    @property
    def all_windows(self) -> tuple[int, ...]:
        """The look-back windows that are computed: the model's, and the 30
        days that risk flags and reports use."""
        return tuple(sorted({*self.windows, 30}))


DEFAULT = Params()

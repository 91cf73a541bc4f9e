"""Thresholds, domains and report texts.

Everything a caller may want to change sits in :class:`Config`; operators take a
``Config`` and never read globals of their own.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

# --- Fixed values -----------------------------------------------------------
# Labels and texts that appear in report rows and therefore have to be spelled
# exactly like this for the results to be the same.
PROFIT_DRIVER = "Profit Driver"
VOLUME_DRIVER = "Volume Driver"
HIDDEN_OPPORTUNITY = "Hidden Opportunity"
LOW_PERFORMER = "Low Performer"
CLASSES = (PROFIT_DRIVER, VOLUME_DRIVER, HIDDEN_OPPORTUNITY, LOW_PERFORMER)

SEGMENTS = ("High-Value Loyal", "Frequent", "Promotion-Driven", "Occasional", "New", "At-Risk")
SEGMENT_PLAYS = {
    "High-Value Loyal": "Reward & keep close",
    "Frequent": "Nudge for one more visit",
    "Promotion-Driven": "Wean off discounts",
    "Occasional": "Re-engage with favourites",
    "New": "Onboard & convert",
    "At-Risk": "Win-back campaign",
}
WEEKDAYS = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")
HOUR_BUCKETS = ("9a", "11a", "1p", "3p", "5p", "7p", "9p", "11p")
GUEST = "GUEST"

HIGH_SENSITIVITY = "Highly Price Sensitive"
MODERATE_SENSITIVITY = "Moderately Price Sensitive"
LOW_SENSITIVITY = "Low Price Sensitivity"
# --- end of fixed values ----------------------------------------------------


@dataclass(frozen=True)
class Config:
    """Tunable parameters of every operator."""

    seed: int = 20260926
    # recency is measured back from here; None = the last order date
    analysis_end: date | None = None
    # four-quadrant classification
    demand_cut: float = 0.55
    profit_cut: float = 0.45
    waste_weight: float = 0.9
    rating_floor: float = 3.6
    rating_penalty: float = 0.12
    default_rating: float = 3.8
    slow_demand: float = 0.35
    slow_waste_pct: float = 8.0
    # forecasting
    horizon: int = 14
    holdout: int = 14
    band_sigmas: float = 1.5
    band_growth: float = 0.03
    # market basket
    min_support: float = 0.004
    support_stop: float = 0.0004
    top_rules: int = 20
    # pricing
    elasticity_prior: float = -0.9
    elasticity_lo: float = -4.0
    elasticity_hi: float = 1.0
    high_sensitivity_cut: float = -1.4
    moderate_sensitivity_cut: float = -0.8
    # promotions
    trap_gap: float = -9.0
    trap_margin: float = 0.50
    good_margin: float = 0.58
    good_share: float = 6.0
    # anomalies
    z_cut: float = 2.1
    z_high: float = 2.8
    margin_collapse: float = 0.75
    outlier_sigmas: float = 4.0
    burst_size: int = 15
    anomaly_rows: int = 8
    # churn
    churn_quantile: float = 0.70
    low_risk: float = 0.35
    medium_risk: float = 0.55
    churn_report_rows: int = 500
    # model fits: partitions of a training table, whatever its size, and the work of the second family
    fit_partitions: int = 8
    boosting_rounds: int = 100
    full_tree_depth: int = 30
    logistic_iterations: int = 1000
    # reports
    view_cap: int = 2000

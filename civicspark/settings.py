"""Every tunable of the engine, as frozen dataclasses passed to the operators."""

from __future__ import annotations

from dataclasses import dataclass, field

# Names that appear in outputs.
UNKNOWN = "UNKNOWN"
GLOBAL_CATEGORY = "__global__"
USAGE = "shadow-not-for-use"

# Srg classes that are reported but never gated.
REPORT_ONLY = {"srg": ("N/A", "FUTURE")}

# Hourly USD by instance type.
HOURLY_USD = {
    "ml.m5.large": 0.115,
    "ml.m5.xlarge": 0.230,
    "ml.t3.medium": 0.050,
    "ml.t3.large": 0.110,
    "ml.t3.xlarge": 0.220,
    "glue.dpu": 0.44,
}
SPOT_FACTOR = 0.30

# The department prefixes tracked by the drift profile.
DEPARTMENTS = (
    "Roads", "WRS", "Bylaw", "Parks", "WATS", "AT", "Corporate", "CT", "DBBS Inspection",
    "Finance", "CFD", "RSP", "DBBS", "AS", "311 Contact Us", "Recreation", "GFL", "CT AC",
    "ACPL", "Opinions on Business Units", "Community Safety", "Business Safety",
    "DBBS Concern", "PSD", "Law", "Active Living Program Application", "HR",
    "After Hours Transit", "VFH", "Customer Service & Communications",
)
OTHER_DEPARTMENT = "Other"

# Cut points of the observed/expected bands.
RATIO_BREAKS = (0.85, 0.95, 1.05, 1.15)


# The default windows and percentile of the labels.
@dataclass(frozen=True)
class LabelSettings:
    """What "late" means: a category's own percentile of resolution time."""

    window_years: int = 5
    holdout_years: int = 1
    percentile: float = 0.75
    purge_handling: str = "flag"  # flag | exclude | keep

    def __post_init__(self):
        if self.purge_handling not in ("flag", "exclude", "keep"):
            raise ValueError(f"unknown purge_handling {self.purge_handling!r}")


# The default limits of the data-quality gate.
@dataclass(frozen=True)
class GateSettings:
    """Limits of the data-quality checks."""

    min_rows: int = 500_000
    max_row_change: float = 0.25
    max_duplicate_id_rate: float = 0.001
    max_null_rate: dict = field(
        default_factory=lambda: {
            "requested_date": 0.0,
            "service_name": 0.001,
            "agency_responsible": 0.01,
            "source": 0.01,
            "comm_name": 0.10,
        }
    )
    max_unparseable_date_rate: float = 0.001
    max_negative_duration_rate: float = 0.005
    max_staleness_days: int = 14
    group_min_rows: int = 200
    bulk_close_day_share: float = 0.25
    bulk_close_min_rows: int = 50
    group_mean_ratio: float = 10.0
    group_mean_min_excess_days: float = 30.0
    stale_close_min_rows: int = 30
    stale_close_age_ratio: float = 10.0
    stale_close_min_age_days: float = 120.0


# The default floors of the fairness report.
@dataclass(frozen=True)
class FairnessSettings:
    """The triage quota and the per-group floors."""

    top_fraction: float = 0.10
    cutoff_by: str | None = "sector"  # None = one city-wide cutoff
    min_group_rows: int = 1_000
    min_group_positives: int = 100
    min_recall_ratio: float = 0.80
    min_group_lift: float = 1.5


# The default floors of the promotion gate.
@dataclass(frozen=True)
class PromotionSettings:
    """Floors a model must clear before it is registered."""

    pr_auc: float = 0.25
    recall_ratio: float = 0.80
    min_group_lift: float = 1.5
    champion_margin: float = 0.005


# The default control limits.
@dataclass(frozen=True)
class ControlSettings:
    """The EWMA chart and the short-history ratio rule."""

    weight: float = 0.3
    limit: float = 3.0
    min_points: int = 10
    run: int = 3
    ratio: float = 2.0


# The default windows and shares of the scorecard.
@dataclass(frozen=True)
class ScorecardSettings:
    segment_category: str = "WRS - Waste - Residential"
    segment_sector: str = "EAST"
    provisional_share: float = 0.06
    slow_pending_share: float = 0.02
    window_months: int = 12
    slowest: float = 0.05
    recent_months: int = 5


@dataclass(frozen=True)
class LateRate:
    """One decided-outcome history feature."""

    name: str
    keys: tuple
    days: int
    min_n: int


# The late-rate features, their keys, windows and least counts.
LATE_RATES = (
    LateRate("cat_late_90d", ("service_name",), 90, 20),
    LateRate("comm_late_90d", ("comm_name",), 90, 20),
    LateRate("sector_late_90d", ("sector",), 90, 20),
    LateRate("cat_sector_late_90d", ("service_name", "sector"), 90, 10),
    LateRate("comm_cat_late_180d", ("service_name", "comm_name"), 180, 5),
)

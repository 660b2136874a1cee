"""Parameters: era boundaries, key sets, detector thresholds."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

POOL_KEYS = ["run_date", "subscription_id", "batch_account_name", "pool_name"]
JOB_KEYS = [*POOL_KEYS, "job_id"]
JOB_ATTRIBUTES = ["job_name", "job_category", "job_ownership", "job_team"]
GATE_KEYS = ["run_date", "subscription_id"]
RAW_GRAIN = ["run_date", "subscription_id", "resource_group_name", "resource_type", "meter", "meter_sub_category", "batch_account_name", "pool_name"]
RUN_TYPES = ["Cost", "Usage", "Attribution"]

# Sentinels that keep null keys apart from each other and from real labels.
NULL_BATCH = "__NULL_BATCH__"
NULL_TEAM = "__NULL_TEAM__"
UNKNOWN = "Unknown"
POOLED = "__POOLED__"


@dataclass(frozen=True)
class Eras:
    """Half-open regimes: before `cost`, then up to `featured`, then up to `gated`, then on."""

    cost: date = date(2022, 8, 1)
    featured: date = date(2023, 8, 1)
    gated: date = date(2024, 1, 2)
    post_glide: date = date(2025, 2, 1)


#: The regimes of the driver's tables, which end in 2001.
LENS_ERAS = Eras(date(1996, 1, 1), date(1997, 1, 1), date(1998, 1, 1), date(1999, 1, 1))
EXCLUDED_TIERS = ("DEV", "TEST")


@dataclass(frozen=True)
class FrameSpec:
    """What a frame predicts, by which groups and over which day column."""

    group_keys: list[str]
    target: str = "cost"
    date_col: str = "run_date"

    def __post_init__(self):
        if not self.group_keys:
            raise ValueError("a frame needs its group keys stated")


@dataclass(frozen=True)
class DetectorConfig:
    """The detector's thresholds; below impact_medium (currency) an alert is low, below impact_high medium at most."""

    target_coverage: float = 0.90
    margin_window_days: int = 90
    min_margin_scores: int = 30
    cusum_k: float = 0.5
    cusum_h: float = 5.0
    cusum_sigma_window: int = 60
    cusum_min_history: int = 20
    z_threshold: float = 5.0
    min_job_history: int = 10
    job_abs_floor: float = 5.0
    unknown_pct_threshold: float = 0.20
    impact_medium: float = 50.0
    impact_high: float = 500.0


@dataclass
class Frame:
    """A built frame with its declaration; df alone would lose it in the next join."""

    df: object
    spec: FrameSpec
    feature_cols: list[str] = field(default_factory=list)
    categorical_cols: list[str] = field(default_factory=list)
    reports: dict = field(default_factory=dict)
    train_origin: date | None = None

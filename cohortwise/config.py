"""Parameters of every layer as frozen dataclasses.

Parameters reach Spark as literals (constant-folded by Catalyst); when a
layer needs several parameter rows at once (A/B sets, per-segment weights,
seasonal thresholds) they become a small DataFrame whose row count is the
number of configured rows, which is what bounds any broadcast of it.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's definitions.
# Status labels, risk levels, alert severities and alert literals.
# ---------------------------------------------------------------------------
ACTIVE = "ACTIVE"
AT_RISK = "AT_RISK"
INACTIVE = "INACTIVE"
DATA_QUALITY_ISSUE = "DATA_QUALITY_ISSUE"
STATUSES = (ACTIVE, AT_RISK, INACTIVE, DATA_QUALITY_ISSUE)

HIGH = "HIGH"
MEDIUM = "MEDIUM"
LOW = "LOW"
LEVELS = (HIGH, MEDIUM, LOW)

CRITICAL = "CRITICAL"
WARNING = "WARNING"
INFO = "INFO"

ALERT_TYPE = "retention_status_degradation"
METRIC_AT_RISK = "at_risk_pct"
SCOPE_GLOBAL = "global"


@dataclass(frozen=True)
class StatusThresholds:
    """Recency boundaries, both inclusive: ``d <= active_days`` is ACTIVE,
    ``d <= at_risk_days`` is AT_RISK, above is INACTIVE, ``d < 0`` is a
    data-quality issue (future order)."""

    active_days: int = 30
    at_risk_days: int = 90
    name: str = "default"

    def __post_init__(self):
        if not (0 <= self.active_days <= self.at_risk_days):
            raise ValueError("need 0 <= active_days <= at_risk_days")


# ---------------------------------------------------------------------------
# Business-model threshold profiles (active, at-risk days).
# Two-number profiles follow the SQL / technical text; the ``*_business``
# variants keep the first two numbers of the business text's three-number
# profiles.
# ---------------------------------------------------------------------------
PROFILES = {
    "ecommerce": StatusThresholds(30, 90, "ecommerce"),
    "fast_fashion": StatusThresholds(15, 45, "fast_fashion"),
    "luxury": StatusThresholds(60, 180, "luxury"),
    "saas": StatusThresholds(30, 90, "saas"),
    "fast_fashion_business": StatusThresholds(15, 30, "fast_fashion_business"),
    "luxury_business": StatusThresholds(90, 180, "luxury_business"),
    "saas_business": StatusThresholds(30, 60, "saas_business"),
    "wide": StatusThresholds(365, 730, "wide"),
}


# Weights, cut points and multipliers of the churn score.
@dataclass(frozen=True)
class RiskWeights:
    """Weights and cut points of the churn score.

    Multipliers are kept in hundredths so that the comparisons
    ``days > gap * 1.5`` become exact integer cross-multiplications
    (``100 * days * (n - 1) > 150 * lifetime``)."""

    frequency_drop: int = 50
    value_drop: int = 30
    status_inconsistent: int = 20
    high_min: int = 51
    medium_min: int = 21
    frequency_factor_pct: int = 150
    inconsistency_factor_pct: int = 70
    value_factor_pct: int = 60
    low_orders_max: int = 3
    value_drop_enabled: bool = False
    engagement: int = 0  # extra points for the optional engagement signal


# The alert's thresholds, sample floor and baseline rows.
@dataclass(frozen=True)
class AlertConfig:
    """Share-vs-baseline alert on one status share."""

    status: str = AT_RISK
    metric_name: str = METRIC_AT_RISK
    alert_type: str = ALERT_TYPE
    scope: str = SCOPE_GLOBAL
    warning_pct: float = 15.0
    critical_pct: float = 25.0
    min_sample: int = 100
    baseline_rows: int = 7
    # rows of history required for a baseline: 1 is the literal predicate
    # (``baseline IS NOT NULL``), 7 the documented warm-up.
    min_history: int = 1
    # "rows" (literal ROWS frame), "range" (calendar days), "same_day_last_week",
    # "median"
    baseline: str = "rows"
    consecutive_days: int = 1
    # "increase" alerts when the share rises (status shares); "decrease" when
    # it falls (retention rates), i.e. the relative change is negated
    direction: str = "increase"

    def with_(self, **kw) -> "AlertConfig":
        return replace(self, **kw)


@dataclass(frozen=True)
class ModelProfile:
    """What a business model changes: status days, the cohort window in
    months (None: all) and the alert."""

    thresholds: StatusThresholds
    cohort_months: int | None = None
    alert: AlertConfig = AlertConfig()


# Adaptations per business model.
MODELS = {
    "ecommerce": ModelProfile(PROFILES["ecommerce"]),
    "saas": ModelProfile(PROFILES["saas_business"], cohort_months=36),
    "luxury": ModelProfile(PROFILES["luxury_business"], cohort_months=24, alert=AlertConfig(baseline_rows=28)),
    "fast_fashion": ModelProfile(PROFILES["fast_fashion_business"], cohort_months=6, alert=AlertConfig(baseline_rows=7)),
}

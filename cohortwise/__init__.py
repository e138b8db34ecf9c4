"""cohortwise — customer-lifecycle analytics as plain Spark DataFrame transformations.

Layers (each a pure function of DataFrames plus explicit parameters):

* ``operators.facts``     per-customer purchase facts (literal or as-of a date)
* ``operators.status``    dated activity status per customer
* ``operators.risk``      explainable, rule-based churn risk
* ``operators.cohorts``   month-by-month cohort retention curves
* ``operators.history``   daily status history in delta form (no customers x days)
* ``operators.alerts``    share-vs-baseline alerts over the daily history
* ``operators.quality``   data-quality checks returning violations / summaries
* ``operators.campaigns`` campaign lists, action matrix, transitions, forecast
"""

from cohortwise.config import (  # noqa: F401
    AlertConfig,
    RiskWeights,
    StatusThresholds,
    PROFILES,
)

__all__ = ["AlertConfig", "RiskWeights", "StatusThresholds", "PROFILES"]

"""Column expressions shared by all layers (JVM-side built-ins only)."""

from cohortwise.functions.dates import day_diff, month_diff, month_start, to_day  # noqa: F401
from cohortwise.functions.numeric import (  # noqa: F401
    exceeds_gap_multiple,
    money,
    share_pct,
)

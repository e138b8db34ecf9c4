"""Sources (adapters onto the logical ``orders`` / ``customers`` / activity
relations) and sinks (partitioned tables, outbox, exports)."""

from cohortwise.sources.testdata import (  # noqa: F401
    customers,
    engagement_events,
    event_purchases,
    orders,
    read_table,
)

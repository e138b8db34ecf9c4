"""Incremental refresh of the facts table, in batch and as a Structured
Streaming ``foreachBatch`` sink."""

from cohortwise.streaming.incremental import incremental_facts, start_facts_refresh  # noqa: F401

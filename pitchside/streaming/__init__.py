"""Incremental landing: new landed payload files -> audited bronze appends + attempt outcomes."""

from pitchside.streaming.landing_stream import queue_from_outcome_log, run_landing_stream

__all__ = ["queue_from_outcome_log", "run_landing_stream"]

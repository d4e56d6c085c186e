"""Streaming entry points (the reference itself is batch-only)."""

from clickvault.streaming.landing import landing_files, run_name, start_landing_trigger

__all__ = ["landing_files", "run_name", "start_landing_trigger"]

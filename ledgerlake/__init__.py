"""ledgerlake: payment-event analytics on Spark DataFrames.

Every operator takes and returns a DataFrame and is built from built-in
Spark SQL functions, so Catalyst can push filters and prune columns through
it and whole-stage codegen stays intact.

Sub-packages:
  sources    event / change-feed / table readers and the derived payment log
  functions  column expressions (amount and timestamp normalisation, payloads)
  operators  validation, deduplication, upserts, life cycle, reports
  streaming  Structured Streaming jobs and batch-atomic sinks
  plans      the named query catalogue and its DuckDB oracle text
"""

from ledgerlake.session import get_session, work_dir

__all__ = ["get_session", "work_dir"]

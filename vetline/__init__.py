"""vetline: message triage and reporting as Spark DataFrame plans.

Messages come in (batch or Structured Streaming), are filtered, deduplicated
against an outcome table, evaluated by a pluggable scorer, routed to exactly one
disposition, and the outcome/channel tables are maintained with upsert
semantics.  Reports are lazy DataFrames over those tables.
"""

__all__ = ["session", "schemas"]

"""orderlens — order analytics on Spark DataFrames.

Ingest raw order CSVs, profile and clean them with NULL-faithful rules,
store them as typed columnar tables, run the twelve order queries, roll
up per-restaurant performance, build the scorecard and reconcile metrics.
Every operator takes and returns a DataFrame; no Python UDF is used.
"""

__version__ = "0.1.0"

"""subledger: subscription-billing table jobs on Spark.

Layout:
  sources/    landed pages, raw/bronze partitions, catalog, sinks, arrival keys
  functions/  column expressions (scalar rules) and ordered aggregates
  operators/  table jobs: timeline, attribution, mrr, active merchants, curate, audit
  plans/      named queries over the driver tables plus their DuckDB oracles
  streaming/  availableNow curate and late-data dedup
  cli.py      spark-submit entry point for scheduled runs of every job
"""

__all__ = ["session", "schemas", "fixtures"]

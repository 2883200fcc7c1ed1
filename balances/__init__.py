"""balances — customer balance analytics expressed as Spark DataFrame jobs.

Layout:
  config       domain constants (one frozen dataclass)
  session      SparkSession / checkpoint-dir helpers
  sources/     table readers, the driver-table adapter, sinks
  functions/   column expressions (scalar functions, decision rules)
  operators/   DataFrame -> DataFrame operators (as-of, panel, rank, stats, ...)
  plans/       registered queries and their DuckDB oracle SQL
  streaming/   intentionally empty: the workload is a monthly batch
"""

__all__ = ["config"]

"""tablelift: move relational tables into columnar files with Spark, and prove nothing was lost.

Layout
  functions/   type table, column expressions (casts, wrap arithmetic), quoting, exact-name columns
  operators/   conform, verification / reconciliation / diff, fixture generators, run-log analytics
  sources/     JDBC read plans, SQLite and Arrow IPC readers (mapInArrow jobs, also Python data
               sources), Parquet-directory and Spark-catalog sources
  sinks/       Parquet sink, staging + atomic swap or versioned publish
  plans/       export job spec, validation, runner and run report, job verification, query registry
  streaming/   batch sizing of cursor reads and of row-group / record-batch writes
"""

__version__ = "0.1.0"

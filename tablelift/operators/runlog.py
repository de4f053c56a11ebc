"""Run-log analytics: throughput, speedup and efficiency of export runs.

Input is a run log with one row per (test, workers, table) export: real rows written and wall
seconds (a decimal column is summed exactly). Runs of 0 seconds have no throughput. Throughput uses the rows actually written (from the run report), not a nominal count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def throughput(log: DataFrame, test: str = "test", workers: str = "workers",
               rows: str = "rows", seconds: str = "seconds") -> DataFrame:
    """(test, workers, runs, rows, seconds, throughput) with throughput = rows / seconds."""
    agg = log.groupBy(F.col(test).alias("test"), F.col(workers).alias("workers")).agg(
        F.count(F.lit(1)).alias("runs"),
        F.sum(F.col(rows).cast("bigint")).alias("rows"),
        F.sum(F.col(seconds)).cast("double").alias("seconds"),
    )
    return agg.withColumn("throughput", F.try_divide(F.col("rows").cast("double"), "seconds"))


def scalability(tp: DataFrame) -> DataFrame:
    """Speedup against the smallest worker count of the same test, and efficiency in percent."""
    w = Window.partitionBy("test").orderBy("workers").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    speedup = F.col("throughput") / F.first("throughput").over(w)
    return tp.withColumn("speedup", speedup).withColumn(
        "efficiency", F.col("speedup") / F.col("workers").cast("double") * F.lit(100.0))


def summary(log: DataFrame, test: str = "test", rows: str = "rows", seconds: str = "seconds") -> DataFrame:
    return log.groupBy(F.col(test).alias("test")).agg(
        F.count(F.lit(1)).alias("runs"),
        F.sum(F.col(rows).cast("bigint")).alias("rows"),
        F.sum(F.col(seconds)).cast("double").alias("seconds"),
        F.max(F.try_divide(F.col(rows).cast("double"), F.col(seconds).cast("double"))).alias("best_throughput"),
    )

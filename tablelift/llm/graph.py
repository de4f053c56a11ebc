"""Connected components of an edge table by alternating star contraction, all in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelift.llm.common import Scratch


def components(edges: DataFrame, scratch: Scratch, src: str, dst: str) -> DataFrame:
    """(node, component) for every node of an edge; component is the smallest node reachable.

    Large-star then small-star rounds: every node hooks its larger neighbours, then its smaller
    ones, to the smallest neighbour, until the edges form stars. Minima are combined map-side, and
    the hub's side of each join is split by AQE, so a hub with a third of all edges is not one
    task. Each round is a written table. Loops and nulls are ignored; an empty table gives none.
    """
    a, b = F.col(src), F.col(dst)
    cur = scratch.table(edges.filter((a != b) & a.isNotNull() & b.isNotNull())
                        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges0")
    done, k = None, 0
    while True:
        sign = cur.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if sign == done or sign[0] == 0:
            break
        done = sign
        both = cur.union(cur.select("v", "u")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hooked = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        k += 1
        new = scratch.table(hooked.union(low.select("u", F.col("m").alias("v"))).distinct(), f"edges{k}")
        scratch.drop(f"edges{k - 1}")
        cur = new
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        cur.select("v", "v").distinct())

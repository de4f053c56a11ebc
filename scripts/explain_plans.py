"""Write PLANS.md: the physical plan tree of every headline operator, with the points to check.

Usage: python scripts/explain_plans.py [sf_dir]   (default /root/testdata/sf0.01)
Only the operator tree of ``explain("formatted")`` is kept (node details are dropped), plus the
scan lines that show pushed filters and read schemas.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted") \
        if hasattr(df._sc._jvm, "PythonSQLUtils") else plan_text(df)
    tree, details = text.split("\n\n", 1) if "\n\n" in text else (text, "")
    keep = [ln for ln in details.splitlines() if re.match(r"^(PushedFilters|ReadSchema|Output \[|Condition)", ln)]
    return tree.strip() + ("\n" + "\n".join(keep[:12]) if keep else "")


def main() -> None:
    from pyspark.sql import functions as F

    from tablelift.operators import fixtures, runlog, verify
    from tablelift.operators.conform import conform
    from tablelift.plans import registry
    from tablelift.session import get_spark

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[8]", **{"spark.sql.shuffle.partitions": "8"})
    li = registry.load(spark, sf, "lineitem")
    orders = registry.load(spark, sf, "orders")
    cases = [
        ("export: scan -> conform -> (write)", "One stage, no Exchange. Casts are one code-generated Project; "
         "CollectMetrics gathers rows and rejects on the way to the writer.",
         conform(li, registry.LINEITEM_DECLARED).df),
        ("query task: filter + projection", "PushedFilters on the timestamp and a 2-column ReadSchema.",
         registry.QUERIES["scan_query_filter"](spark, sf)),
        ("query task: join + aggregate", "Orders are aggregated per customer (partial aggregate before the "
         "Exchange) before the join, so a hot customer collapses map-side; the join strategy is Spark's "
         "size-checked choice (AQE).", registry.QUERIES["scan_query_agg"](spark, sf)),
        ("reconcile (one side)", "Two global aggregates, partial per task, one row per task through each "
         "Exchange: a code-generated HashAggregate over the whole scan (counts, fixed-width min/max, hashes) and "
         "a SortAggregate over a scan pruned to the string columns (their min/max). The final merge sees one row "
         "per column.", verify.profile(orders)),
        ("multiset diff", "One Exchange on the row columns for both sides (tagged +1/-1), partial aggregate "
         "below it; only surpluses above the chunk size are re-spread (second, small Exchange). The initial plan "
         "below lists the aggregate under both branches; at run time the second branch reads the same shuffle "
         "(its map stage is skipped: checked with the status tracker), and AQE drops it when no row is hot.",
         verify.diff_except_all(li, li.where(F.col("l_returnflag") != "R"))),
        ("first / last", "min_by / max_by in one global aggregate; no sort of the table.",
         verify.first_last(orders, "o_orderkey")),
        ("peek (top-k)", "TakeOrderedAndProject: a per-partition top-k and a merge, not a full sort.",
         verify.peek(orders, "o_totalprice", 10, descending=True)),
        ("point lookup", "The key list is pushed into the Parquet scan (In filter).",
         verify.point_lookup(orders, "o_orderkey", [1, 500, 1000])),
        ("null counts", "One global aggregate of count_if per column.",
         verify.null_counts(fixtures.nullable_test(fixtures.ids_from(orders, "o_orderkey")))),
        ("fixture: 20 table copies", "A Generate (explode of a 20-element sequence), no join.",
         fixtures.export_tables(fixtures.ids_from(orders, "o_orderkey"))),
        ("scalability (window)", "Aggregate by (test, workers), then one window partitioned by test.",
         runlog.scalability(registry._runlog_tp(spark, sf))),
    ]
    out = ["# PLANS", "", f"Physical plans at `{sf}` (`local[8]`), from `scripts/explain_plans.py`. "
           "Each section says what to look for; the tree is Spark's own output.", ""]
    for title, note, df in cases:
        out += [f"## {title}", "", note, "", "```", formatted(df), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(out))
    print(path)
    spark.stop()


if __name__ == "__main__":
    main()

"""Write the physical plans of the main queries to PLANS.md.

Usage: python scripts/show_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from landfall.plans import fixtures as fx  # noqa: E402
from landfall.plans import queries as q  # noqa: E402
from landfall.plans.layers import accepted, rejects  # noqa: E402
from landfall.plans.marts import revenue_by_nation_year  # noqa: E402

NOTES = {
    "extract_query": "Filter and projection reach the Parquet scan (PushedFilters, ReadSchema).",
    "dedup_latest": "Partial WindowGroupLimit before the exchange: a hot key ships one row per map partition.",
    "dedup_exact": "Survivors found on SHA-256 fingerprints with partial aggregation; wide rows meet their ids in a semi join.",
    "orphan_rows": "Anti join; the parent side is read as one key column.",
    "upsert_latest (merge)": "Anti join on the change keys; Spark broadcasts them here, by their size, and shuffles both sides beyond it.",
    "dwh_fact": "Customers meet orders before the lines do; Spark picks broadcast or shuffled joins by size.",
    "revenue_by_nation_year": "Lines summed per order, then per (customer, year), before each join.",
    "typed accepted side": "Only the _rejected=false partition is listed; the _rejects column is not read.",
    "typed rejects side": "Only the _rejected=true partition, keys and the entry array are read.",
}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "16")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    t = lambda n: spark.read.parquet(f"{sf_dir}/{n}.parquet")
    from landfall.operators.upsert import merge_latest

    store = q._typed_dirty(spark, sf_dir, "plans")
    frames = {
        "extract_query": q.extract_query(spark, sf_dir),
        "dedup_latest": q.dedup_latest(spark, sf_dir),
        "dedup_exact": q.dedup_exact(spark, sf_dir),
        "orphan_rows": q.orphan_rows(spark, sf_dir),
        "upsert_latest (merge)": merge_latest(t("orders"), fx.order_changes(t("orders")), ["o_orderkey"]),
        "dwh_fact": q._fact(spark, sf_dir),
        "revenue_by_nation_year": revenue_by_nation_year(q._clean_lines(spark, sf_dir), t("orders"), t("customer"), t("nation")),
        "typed accepted side": accepted(store, "dirty", "lineitem"),
        "typed rejects side": rejects(store, "dirty", fx.LINEITEM_RULE),
    }
    out = [f"# Physical plans\n\nGenerated by `scripts/show_plans.py` at `{sf_dir}` (local[8], AQE on; "
           "the final plan may change at run time).\n"]
    for name, df in frames.items():
        plan = df._jdf.queryExecution().executedPlan().treeString()
        out.append(f"## {name}\n\n{NOTES[name]}\n\n```\n{plan.strip()}\n```\n")
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()

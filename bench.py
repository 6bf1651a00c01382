"""Time the headline queries and print one JSON line.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8), ``BENCH_QUERIES`` (comma list, default the headline set),
``BENCH_WARMUP_DIR`` (default /root/testdata/sf0.001 when present; empty to
skip). Each query runs to completion: loads write their tables, and the
returned frame is drained with a ``noop`` write so every row is computed.

Every headline query first runs once, untimed, on the small warm-up tables,
so the timings measure steady-state work rather than the JVM compiling each
code path for the first time (on a cluster that cost is paid once per
executor, not per load). ``warmup_sec_small_sf`` reports those warm-up runs.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from landfall.plans.queries import QUERIES  # noqa: E402

HEADLINE = [
    "pipeline_report",
    "dedup_latest",
    "full_refresh",
    "upsert_latest",
    "typed_accepted",
    "reject_rows",
    "dedup_exact",
    "dwh_fact",
    "dwh_report",
    "orphan_rows",
    "incremental_hwm",
    "multi_source_stage",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [q for q in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if q]
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("landfall-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cpus * 2))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    cold: dict[str, float] = {}
    if warm_dir and os.path.isdir(warm_dir):
        for name in names:
            t0 = time.perf_counter()
            QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
            cold[name] = round(time.perf_counter() - t0, 3)

    timings: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)
    lineitem_rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    inputs = {
        "pipeline_report": lineitem_rows,
        "dedup_latest": lineitem_rows,
        "full_refresh": spark.read.parquet(f"{sf_dir}/customer.parquet").count(),
        "upsert_latest": spark.read.parquet(f"{sf_dir}/orders.parquet").count(),
    }
    rows_per_sec = {q: round(n / timings[q], 1) for q, n in inputs.items() if timings.get(q)}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "spark": spark.version,
        "lineitem_rows": lineitem_rows,
        "driver_memory": spark.conf.get("spark.driver.memory", "16g"),
        "rows_per_sec": rows_per_sec,
        "warmup_sec_small_sf": cold,
    }
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()

"""A daily warehouse load, end to end, from a JSON configuration.

    spark-submit examples/warehouse_job.py config.json

config.json (credentials are passed in, never stored in code)::

    {
      "warehouse": "hdfs:///warehouse",            # optional; default: spark.checkpoint.dir
      "sql_root": "sql",                            # sql/stg/<source>/*.sql, sql/tf/<source>/*.sql, sql/dwh/*.sql
      "sources": [
        {"name": "erp_a", "url": "jdbc:sqlserver://host-a:1433;databaseName=erp",
         "driver": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
         "properties": {"user": "...", "password": "..."}, "num_partitions": 64,
         "extracts": {"orders": {"column": "changed_at", "keys": ["id"], "lookback_days": 3,
                                 "merge": "upsert", "read_by": "id"}}},
        {"name": "lake_b", "type": "parquet", "dir": "/data/lake_b", "tables": ["orders", "customer"]}
      ]
    }

``extracts`` has the settings of those queries that are not read in full by one
connection: increments (``column``, ``keys``, ...) and parallel strides
(``read_by``); see :class:`landfall.Extract`.

Layers run in order (staging → transformed → final); each step publishes
its table only after its write succeeded and logs an audit row either way.
JDBC sources need their databases; Parquet sources run anywhere.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from landfall.plans.layers import run_pipeline  # noqa: E402
from landfall.plans.steps import steps_from_dir  # noqa: E402
from landfall.session import shared_dir  # noqa: E402
from landfall.sources.catalog import Extract, catalog_from_dir  # noqa: E402
from landfall.sources.jdbc import JdbcSource  # noqa: E402
from landfall.sources.lake import ParquetSource  # noqa: E402
from landfall.tables.store import TableStore  # noqa: E402


def make_source(spec: dict):
    if spec.get("type", "jdbc") == "parquet":
        return ParquetSource.from_dir(spec["name"], spec["dir"], spec["tables"])
    names = ("name", "url", "server", "database", "driver", "options", "properties", "num_partitions", "balanced")
    return JdbcSource(**{k: spec[k] for k in names if k in spec})


def make_catalog(directory: str, extracts: dict) -> dict[str, Extract]:
    """The folder's queries with their settings from the configuration."""
    catalog = {}
    for table, query in catalog_from_dir(directory).items():
        spec = dict(extracts.get(table, {}))
        if "lookback_days" in spec:
            spec["lookback"] = dt.timedelta(days=spec.pop("lookback_days"))
        lists = {k: tuple(spec.pop(k)) for k in ("keys", "order") if k in spec}
        catalog[table] = Extract(query, **spec, **lists)
    return catalog


def main(config_path: str, spark: SparkSession | None = None) -> TableStore:
    with open(config_path, encoding="utf-8") as fh:
        config = json.load(fh)
    spark = spark or SparkSession.builder.appName("warehouse-load").getOrCreate()
    store = TableStore(spark, config.get("warehouse") or f"{shared_dir(spark)}/warehouse")
    sql = config.get("sql_root", "sql")
    sources = [make_source(s) for s in config["sources"]]

    def folder(*parts: str) -> str:
        return os.path.join(sql, *parts)

    run_pipeline(
        spark,
        store,
        sources=sources,
        catalogs={
            spec["name"]: make_catalog(folder("stg", spec["name"]), spec.get("extracts", {}))
            for spec in config["sources"]
        },
        tf_steps={s.name: steps_from_dir(folder("tf", s.name)) for s in sources if os.path.isdir(folder("tf", s.name))},
        dwh_steps=steps_from_dir(folder("dwh")) if os.path.isdir(folder("dwh")) else (),
    )
    return store


if __name__ == "__main__":
    main(sys.argv[1])

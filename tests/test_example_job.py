"""The example job end to end on Parquet sources: config + SQL folders."""

import importlib.util
import json
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from landfall.session import scratch_dir


def load_example():
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "examples", "warehouse_job.py")
    spec = importlib.util.spec_from_file_location("warehouse_job", path)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


def test_example_job_runs_all_layers(tmp_path, spark):
    sql = tmp_path / "sql"
    for src in ("a", "b"):
        (sql / "stg" / src).mkdir(parents=True)
        (sql / "stg" / src / "orders.sql").write_text(
            f"select * from orders where o_orderkey % 2 = {0 if src == 'a' else 1};")
        (sql / "tf" / src).mkdir(parents=True)
        (sql / "tf" / src / "orders.sql").write_text(
            f"select cast(o_orderkey as bigint) as o_orderkey, try_cast(o_totalprice as decimal(12,2)) as price\n"
            f"from {src}_stg_orders")
    (sql / "dwh").mkdir()
    (sql / "dwh" / "all_orders.sql").write_text(
        "select o_orderkey, price from a_tf_orders union all select o_orderkey, price from b_tf_orders")
    config = {
        "warehouse": scratch_dir(spark, "example"),
        "sql_root": str(sql),
        "sources": [{"name": s, "type": "parquet", "dir": SF_SMALL, "tables": ["orders"]} for s in ("a", "b")],
    }
    config["sources"][1]["extracts"] = {
        "orders": {"column": "o_orderdate", "keys": ["o_orderkey"], "lookback_days": 3, "merge": "upsert"}
    }
    cfg = tmp_path / "config.json"
    cfg.write_text(json.dumps(config))
    store = load_example().main(str(cfg), spark)
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    got = store.read("dwh.all_orders")
    assert got.count() == orders.count()
    assert got.agg(F.sum("price")).first()[0] == orders.agg(F.sum(F.col("o_totalprice").cast("decimal(12,2)"))).first()[0]
    statuses = {r["table_name"]: r["status"] for r in store.audit().collect()}
    assert statuses == {"a_stg.orders": 1, "b_stg.orders": 1, "a_tf.orders": 1, "b_tf.orders": 1, "dwh.all_orders": 1}

from pyspark.sql import functions as F

from conftest import SF_SMALL
from landfall.plans import fixtures as fx
from landfall.plans.layers import run_pipeline, transformed_table
from landfall.plans.marts import revenue_by_nation_year
from landfall.sources.catalog import catalog_from_dir, stage_catalog
from landfall.sources.lake import ParquetSource
from landfall.tables.audit import reconcile

TABLES = ["lineitem", "orders", "customer", "nation"]
RULES = {"tpch": [fx.LINEITEM_RULE, fx.ORDERS_RULE, fx.CUSTOMER_RULE, fx.NATION_RULE]}


def final(spark, st):
    report = revenue_by_nation_year(*[st.read(transformed_table("tpch", t)) for t in TABLES])
    return [st.publish(report, "dwh.report", layer="dwh")]


def test_layers_in_order_and_resume_from_tf(spark, store):
    src = ParquetSource.from_dir("tpch", SF_SMALL, TABLES)
    out = run_pipeline(spark, store, sources=[src], catalogs={"tpch": {t: f"select * from {t}" for t in TABLES}},
                       rules=RULES, final=final)
    assert [len(out[k]) for k in ("stg", "tf", "dwh")] == [4, 8, 1]
    first = store.read("dwh.report").collect()
    # Start again from the transformed layer: staging is read as published.
    again = run_pipeline(spark, store, rules=RULES, final=final, layers=("tf", "dwh"))
    assert "stg" not in again
    assert sorted(store.read("dwh.report").collect()) == sorted(first)
    bad = reconcile(store.audit()).filter(~F.col("balanced"))
    assert bad.count() == 0


def test_catalog_from_dir_sorted(tmp_path, spark, store):
    (tmp_path / "b_orders.sql").write_text("select o_orderkey from orders where o_orderstatus = 'F';")
    (tmp_path / "a_nation.sql").write_text("select * from nation")
    (tmp_path / "readme.md").write_text("not a query")
    catalog = catalog_from_dir(str(tmp_path))
    assert list(catalog) == ["a_nation", "b_orders"]
    src = ParquetSource.from_dir("s1", SF_SMALL, ["nation", "orders"])
    res = stage_catalog(spark, store, src, catalog)
    assert [r.table for r in res] == ["s1_stg.a_nation", "s1_stg.b_orders"]
    assert res[0].rows_written == 25
    staged = store.read("s1_stg.b_orders")
    assert staged.schema["o_orderkey"].dataType.simpleString() == "string"


def test_failing_extract_stops_and_is_logged(spark, store):
    import pytest

    src = ParquetSource.from_dir("s1", SF_SMALL, ["nation"])
    with pytest.raises(Exception):
        stage_catalog(spark, store, src, {"good": "select * from nation", "bad": "select nope from nation"},
                      max_workers=1)
    status = {r["table_name"]: r["status"] for r in store.audit().collect()}
    assert status == {"s1_stg.good": 1, "s1_stg.bad": 0}


def test_sql_step_folders_per_layer(tmp_path, spark, store):
    from landfall.plans.steps import steps_from_dir

    tf_dir = tmp_path / "tf" / "s1"
    tf_dir.mkdir(parents=True)
    (tf_dir / "01_orders.sql").write_text(
        "select cast(o_orderkey as bigint) as o_orderkey, cast(o_custkey as bigint) as o_custkey,\n"
        "       try_cast(o_totalprice as decimal(12,2)) as o_totalprice from s1_stg_orders;")
    dwh_dir = tmp_path / "dwh"
    dwh_dir.mkdir()
    (dwh_dir / "01_customer_value.sql").write_text(
        "select o_custkey, count(*) as order_count, sum(o_totalprice) as total from s1_tf_01_orders group by o_custkey")
    src = ParquetSource.from_dir("s1", SF_SMALL, ["orders"])
    out = run_pipeline(spark, store, sources=[src], catalogs={"s1": {"orders": "select * from orders"}},
                       tf_steps={"s1": steps_from_dir(str(tf_dir))}, dwh_steps=steps_from_dir(str(dwh_dir)))
    assert [r.table for r in out["tf"]] == ["s1_tf.01_orders"]
    assert [r.table for r in out["dwh"]] == ["dwh.01_customer_value"]
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    got = store.read("dwh.01_customer_value")
    assert got.agg(F.sum("order_count")).first()[0] == orders.count()
    assert got.count() == orders.select("o_custkey").distinct().count()


def test_run_layer_one_at_a_time(spark, store):
    from landfall.plans.layers import run_layer

    src = ParquetSource.from_dir("tpch", SF_SMALL, TABLES)
    stg = run_layer(spark, store, "stg", sources=[src], catalogs={"tpch": {t: f"select * from {t}" for t in TABLES}})
    assert len(stg) == 4 and all(r.status == 1 for r in stg)
    tf = run_layer(spark, store, "tf", rules=RULES)
    assert len(tf) == 8
    dwh = run_layer(spark, store, "dwh", final=final)
    assert [r.table for r in dwh] == ["dwh.report"]

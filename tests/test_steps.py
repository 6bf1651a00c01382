import pytest

from conftest import SF_SMALL
from landfall.plans.queries import FAILING_STEPS, STEPS
from landfall.plans.steps import Step, StepFailed, run_steps, steps_from_dir
from landfall.sources.lake import ParquetSource


def test_steps_run_in_order_and_publish(spark, store):
    ParquetSource.from_dir("tpch", SF_SMALL, ["lineitem", "orders"]).register(spark)
    done = run_steps(spark, store, STEPS, prefix="dwh.")
    assert [r.table for r in done] == [f"dwh.{s.name}" for s in STEPS]
    assert all(r.status == 1 for r in done)
    assert store.read("dwh.s03_customer_totals").count() > 0


def test_failing_step_stops_and_keeps_earlier(spark, store):
    ParquetSource.from_dir("tpch", SF_SMALL, ["orders"]).register(spark)
    with pytest.raises(StepFailed) as err:
        run_steps(spark, store, FAILING_STEPS, prefix="dwh.")
    assert err.value.step == "f02_broken"
    assert [r.table for r in err.value.done] == ["dwh.f01_customer_orders"]
    assert store.exists("dwh.f01_customer_orders")
    assert not store.exists("dwh.f02_broken") and not store.exists("dwh.f03_never_runs")
    statuses = {r["table_name"]: r["status"] for r in store.audit().collect()}
    assert statuses == {"dwh.f01_customer_orders": 1, "dwh.f02_broken": 0}


def test_steps_from_dir_sorted_and_semicolon(tmp_path, spark, store):
    (tmp_path / "b_second.sql").write_text("select n from a_first where n > 1;\n")
    (tmp_path / "a_first.sql").write_text("select id as n from range(5)")
    (tmp_path / "notes.txt").write_text("ignored")
    steps = steps_from_dir(str(tmp_path))
    assert [s.name for s in steps] == ["a_first", "b_second"]
    run_steps(spark, store, steps)
    assert store.read("b_second").count() == 3


def test_empty_dir_gives_no_steps(tmp_path):
    assert steps_from_dir(str(tmp_path)) == []


def test_a_step_never_hides_a_view_it_did_not_make(spark, store):
    spark.range(3).createOrReplaceTempView("bought")
    steps = [Step("first", "select 1 as n"), Step("bought", "select 2 as n"), Step("after", "select * from Bought")]
    with pytest.raises(StepFailed, match="rename the step") as err:
        run_steps(spark, store, steps, prefix="x.")
    assert [r.table for r in err.value.done] == ["x.first"] and not store.exists("x.bought")
    run_steps(spark, store, [*steps[:2], Step("after", "select * from x_bought")], prefix="x.")
    assert spark.table("bought").count() == 3 and store.read("x.after").first().n == 2
    run_steps(spark, store, steps[:1])
    run_steps(spark, store, steps[:1])  # a step's own view of before may be replaced


def test_an_empty_step_is_logged_as_failed(spark, store):
    with pytest.raises(StepFailed):
        run_steps(spark, store, [Step("empty_step", " ; ")])
    assert [r["status"] for r in store.audit("empty_step").collect()] == [0]

"""The registered queries: one per operator of the inventory.

Every callable takes ``(spark, sf_dir)``, reads the driver's tables from
``sf_dir`` (or what Spark derives from them) and returns a DataFrame. Queries
that load tables write to a fresh folder under the session's shared
checkpoint folder and return what a reader of the published table sees.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.functions.casts import parse_as, parse_boolean, parse_int, parse_timestamp
from landfall.operators.dedup import duplicate_groups, keep_latest
from landfall.operators.diff import content_differences
from landfall.operators.entities import MatchRule, match_entities, surviving_records
from landfall.operators.history import as_of, close_and_open, validity
from landfall.operators.profile import merge_profiles, profile_text, proposed_type
from landfall.operators.staging import spread, to_text
from landfall.plans import fixtures as fx
from landfall.plans.early_facts import Side, load_lines, parked_lines, place_parked, placed_lines
from landfall.plans.layers import (
    accepted,
    merge_increment,
    rejects,
    repair_rejects,
    run_pipeline,
    transform_increment,
    transform_source,
    transformed_table,
    type_table,
)
from landfall.plans.marts import (
    fact_lines,
    orphans,
    revenue_by_nation_year,
    segment_month_report,
    unmatched_lines,
)
from landfall.plans.reports import keep_report
from landfall.plans.steps import Step, StepFailed, run_steps
from landfall.session import scratch_dir
from landfall.sources.catalog import stage_catalog, staging_table
from landfall.sources.incremental import load_increment
from landfall.sources.lake import ParquetSource, read_table
from landfall.streaming.landing import Landing, load_landed_files
from landfall.tables.audit import reconcile as reconcile_audit
from landfall.tables.keymap import extend_key_map, with_surrogate
from landfall.tables.snapshots import changes_table, load_snapshot
from landfall.tables.store import TableStore

Query = Callable[[SparkSession, str], DataFrame]


def _store(spark: SparkSession, label: str) -> TableStore:
    return TableStore(spark, scratch_dir(spark, label))


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


# -- flagship ---------------------------------------------------------------

def report_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "n_name",
        F.col("o_year").cast("int").alias("o_year"),
        F.col("line_count").cast("bigint").alias("line_count"),
        F.col("sum_qty").cast("decimal(38,2)").alias("sum_qty"),
        F.col("revenue").cast("decimal(38,4)").alias("revenue"),
    )


def pipeline_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage four tables as text, type and deduplicate them, publish revenue by nation and year."""
    store = _store(spark, "pipeline_report")
    tables = ["lineitem", "orders", "customer", "nation"]
    src = ParquetSource.from_dir("tpch", sf_dir, tables)

    def final(spark_: SparkSession, st: TableStore):
        report = revenue_by_nation_year(
            *[st.read(transformed_table("tpch", t)) for t in tables]
        )
        return [st.publish(report_columns(report), "dwh.revenue_by_nation_year", layer="dwh", source="tpch")]

    run_pipeline(
        spark,
        store,
        sources=[src],
        catalogs={"tpch": {t: f"select * from {t}" for t in tables}},
        rules={"tpch": [fx.LINEITEM_RULE, fx.ORDERS_RULE, fx.CUSTOMER_RULE, fx.NATION_RULE]},
        final=final,
    )
    return store.read("dwh.revenue_by_nation_year")


# -- sources ----------------------------------------------------------------

EXTRACT_SQL = (
    "select o_orderkey, o_custkey, o_totalprice, o_orderdate\n"
    "from orders\n"
    "where o_orderstatus = 'F' and o_totalprice > 100000;\n"
)


def extract_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ParquetSource.from_dir("tpch", sf_dir, ["orders"]).extract(spark, EXTRACT_SQL)


CATALOG = {
    "customer_names": "select c_custkey, c_name, c_nationkey from customer",
    "open_orders": "select * from orders where o_orderstatus = 'O';",
    "nation": "select n_nationkey, n_name from nation",
}


def extract_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark, "extract_catalog")
    src = ParquetSource.from_dir("tpch", sf_dir, ["customer", "orders", "nation"])
    stage_catalog(spark, store, src, CATALOG)
    return store.audit().filter(F.col("status") == 1).select("table_name", "rows_written")


def multi_source_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark, "multi_source_stage")
    frames = []
    for k, name in enumerate(fx.SOURCE_NAMES):
        src = ParquetSource.from_dir(name, sf_dir, ["orders"])
        stage_catalog(spark, store, src, {"orders": fx.source_query(k)})
        frames.append(store.read(staging_table(name, "orders")).select(F.lit(name).alias("source"), "*"))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def incremental_hwm(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark, "incremental_hwm")
    events = _t(spark, sf_dir, "events")
    kw = dict(keys=["event_id"], column="ts", lookback=dt.timedelta(days=3), merge="insert_new", source="events")
    load_increment(store, fx.first_event_load(events), "events_stg.events", **kw)
    load_increment(store, events, "events_stg.events", **kw)
    return store.read("events_stg.events")


def incremental_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "incremental_stream")
    store = TableStore(spark, f"{root}/warehouse")
    landing = f"{root}/landing"
    events = _t(spark, sf_dir, "events")
    mid = F.lit("2024-01-16").cast("timestamp_ntz")
    kw = dict(checkpoint_dir=f"{root}/checkpoint", source="events")
    events.filter(F.col("ts") < mid).write.mode("append").parquet(landing)
    load_landed_files(spark, store, landing, events.schema, "events_stg.events", **kw)
    events.filter(F.col("ts") >= mid).write.mode("append").parquet(landing)
    load_landed_files(spark, store, landing, events.schema, "events_stg.events", **kw)
    return store.read("events_stg.events")


def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshots of orders without a change column: what came, changed and went, from the buckets that differ."""
    store = _store(spark, "snapshot_diff")
    first, second = fx.order_snapshots(_t(spark, sf_dir, "orders"))
    for snapshot in (first, second, second):
        load_snapshot(store, snapshot, "erp_stg.orders", ["o_orderkey"], buckets=64, source="erp")
    changes = store.read(changes_table("erp_stg.orders"))
    return changes.select(
        F.coalesce("new.o_orderkey", "old.o_orderkey").alias("o_orderkey"),
        "kind",
        F.array_join("changed", ",").alias("changed"),
        F.col("old.o_orderstatus").alias("old_status"),
        F.col("new.o_orderstatus").alias("new_status"),
    )


# -- sinks and audit --------------------------------------------------------

def load_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark, "load_append")
    customer = _t(spark, sf_dir, "customer")
    store.append(customer.filter(F.col("c_custkey") % 2 == 0), "crm_stg.customer", source="crm")
    store.append(customer.filter(F.col("c_custkey") % 2 == 1), "crm_stg.customer", source="crm")
    return store.read("crm_stg.customer")


def full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark, "full_refresh")
    customer = _t(spark, sf_dir, "customer")
    store.refresh(customer, "crm_stg.customer", source="crm")
    store.refresh(customer.filter(F.col("c_acctbal") > 0), "crm_stg.customer", source="crm")
    return store.read("crm_stg.customer")


def load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark, "load_audit")
    src = ParquetSource.from_dir("tpch", sf_dir, ["customer", "orders", "nation"])
    stage_catalog(spark, store, src, {t: f"select * from {t}" for t in ["customer", "orders", "nation"]})
    try:
        stage_catalog(spark, store, src, {"broken": "select no_such_column from orders"})
    except Exception:
        pass  # logged with status 0; nothing published
    return store.audit().select("source", "table_name", "status", "mode", "rows_written")


# -- casts, rejects, duplicates ---------------------------------------------

def stage_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_text(_t(spark, sf_dir, "lineitem"))


def _dirty(spark: SparkSession, sf_dir: str, spread_first: bool = False) -> DataFrame:
    lines = _t(spark, sf_dir, "lineitem")
    return fx.dirty_lineitem(spread(lines) if spread_first else lines)


def _land_dirty(store: TableStore, spark: SparkSession, sf_dir: str) -> None:
    """The dirty text lands in staging the way an extract does (spread, then written)."""
    store.refresh(_dirty(spark, sf_dir, spread_first=True), staging_table("dirty", "lineitem"), source="dirty", layer="stg")


def _cast_column(spark: SparkSession, sf_dir: str, column: str) -> DataFrame:
    dirty = _dirty(spark, sf_dir)
    spec = next(s for s in fx.LINEITEM_RULE.specs if s.name == column)
    return dirty.select(
        parse_int("l_orderkey", "bigint").alias("l_orderkey"),
        parse_int("l_linenumber", "int").alias("l_linenumber"),
        F.col(column).alias("raw_value"),
        parse_as(column, spec.type, spec.formats).alias("value"),
    )


def cast_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cast_column(spark, sf_dir, "l_partkey")


def cast_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cast_column(spark, sf_dir, "l_extendedprice")


def cast_boolean(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = fx.boolean_text(_t(spark, sf_dir, "customer"))
    return words.select("c_custkey", "raw_value", parse_boolean("raw_value").alias("value"))


def cast_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = fx.date_text(_t(spark, sf_dir, "orders"))
    return text.select("o_orderkey", "raw_value", parse_timestamp("raw_value", ("iso", "dd.MM.yyyy")).alias("value"))


def _typed_dirty(spark: SparkSession, sf_dir: str, label: str) -> TableStore:
    store = _store(spark, label)
    _land_dirty(store, spark, sf_dir)
    type_table(store, "dirty", fx.LINEITEM_RULE)
    return store


def typed_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accepted(_typed_dirty(spark, sf_dir, "typed_accepted"), "dirty", "lineitem")


def reject_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejects(_typed_dirty(spark, sf_dir, "reject_rows"), "dirty", fx.LINEITEM_RULE)


def incremental_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty lines staged in three loads (keys recur across them); each is typed and merged alone."""
    store = _store(spark, "incremental_transform")
    dirty = _dirty(spark, sf_dir).withColumn("_load", fx.load_of_line())
    for load in range(3):
        store.append(dirty.filter(F.col("_load") == load).drop("_load"), staging_table("dirty", "lineitem"), source="dirty", layer="stg")
        transform_increment(store, "dirty", fx.LINEITEM_RULE)
    return store.read(transformed_table("dirty", "lineitem"))


def landed_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty lines land as files in two runs of the layered pipeline, a batch per file; each batch is typed and merged once."""
    root = scratch_dir(spark, "landed_pipeline")
    store = TableStore(spark, f"{root}/warehouse")
    dirty = _dirty(spark, sf_dir)
    zone = Landing(f"{root}/landing", dirty.schema, f"{root}/checkpoint", max_files_per_trigger=4, compact_after=3)
    for run in (0, 1, 2):
        dirty.filter(fx.load_of_line() == run).repartition(5).write.mode("append").parquet(zone.path)
        run_pipeline(
            spark, store, sources=[ParquetSource("dirty")], catalogs={"dirty": {"lineitem": zone}},
            rules={"dirty": [fx.LINEITEM_RULE]}, layers=("stg", "tf"), increments=True,
        )
    return store.read(transformed_table("dirty", "lineitem"))


def repaired_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines staged in two loads; between them the rule learns a date format and the rejects are typed again."""
    store = _store(spark, "repaired_rejects")
    dirty = fx.lines_with_slashed_dates(_dirty(spark, sf_dir)).withColumn("_load", fx.load_of_line())
    for rule, load in ((fx.LINEITEM_RULE, "_load < 2"), (fx.REPAIRED_RULE, "_load = 2")):
        store.append(dirty.filter(load).drop("_load"), staging_table("dirty", "lineitem"), source="dirty", layer="stg")
        transform_increment(store, "dirty", rule)
    repair_rejects(store, "dirty", fx.REPAIRED_RULE)
    merge_increment(store, "dirty", fx.REPAIRED_RULE)
    return store.read(transformed_table("dirty", "lineitem"))


def type_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty lines profiled in three parts, merged, with the type each column fits."""
    dirty = fx.lines_with_slashed_dates(_dirty(spark, sf_dir))
    parts = [profile_text(dirty.filter(fx.load_of_line() == load), fx.PROFILE_FORMATS) for load in range(3)]
    merged = merge_profiles(parts[2].union(parts[0]).union(parts[1]), fx.PROFILE_FORMATS)
    return merged.withColumn("proposed", proposed_type()).select(
        "*", *[F.get("by_format", F.lit(i)).alias(f"format_{i}") for i in range(len(fx.PROFILE_FORMATS))]
    ).drop("by_format")


def dedup_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_groups(_t(spark, sf_dir, "documents"), "text", "doc_id")


def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_latest(_t(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["-l_shipdate"])


def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark, "reconcile")
    _land_dirty(store, spark, sf_dir)
    for t in ("orders", "customer"):
        store.refresh(spread(to_text(_t(spark, sf_dir, t))), staging_table("dirty", t), source="dirty", layer="stg")
    transform_source(store, "dirty", [fx.LINEITEM_RULE, fx.ORDERS_RULE, fx.CUSTOMER_RULE])
    checked = reconcile_audit(store.audit())
    final = F.col("table_name").contains("_tf.") & ~F.col("table_name").endswith("__typed")
    return checked.filter(final).drop("load_id")


# -- steps ------------------------------------------------------------------

STEPS = (
    Step(
        "s01_order_lines",
        "select l_orderkey, count(*) as line_count,\n"
        "       sum(cast(l_quantity as decimal(12,2))) as qty\n"
        "from lineitem group by l_orderkey;",
    ),
    Step(
        "s02_orders_enriched",
        "select o.o_orderkey, o.o_custkey, s.line_count, s.qty\n"
        "from orders o join s01_order_lines s on o.o_orderkey = s.l_orderkey",
    ),
    Step(
        "s03_customer_totals",
        "select o_custkey, count(*) as order_count, cast(sum(line_count) as bigint) as line_count,\n"
        "       cast(sum(qty) as decimal(38,2)) as qty\n"
        "from s02_orders_enriched group by o_custkey",
    ),
)


def run_steps_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark, "run_steps")
    ParquetSource.from_dir("tpch", sf_dir, ["lineitem", "orders"]).register(spark)
    run_steps(spark, store, STEPS, layer="dwh", prefix="dwh.")
    return store.read("dwh.s03_customer_totals")


FAILING_STEPS = (
    Step(
        "f01_customer_orders",
        "select o_custkey, count(*) as order_count,\n"
        "       cast(sum(cast(o_totalprice as decimal(12,2))) as decimal(38,2)) as total\n"
        "from orders group by o_custkey",
    ),
    Step("f02_broken", "select o_custkey, assert_true(order_count < 0) as never from f01_customer_orders"),
    Step("f03_never_runs", "select * from f02_broken"),
)


def step_isolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark, "step_isolation")
    ParquetSource.from_dir("tpch", sf_dir, ["orders"]).register(spark)
    try:
        run_steps(spark, store, FAILING_STEPS, layer="dwh", prefix="dwh.")
    except StepFailed:
        pass
    visible = [s.name for s in FAILING_STEPS if store.exists(f"dwh.{s.name}")]
    if visible != ["f01_customer_orders"]:
        raise AssertionError(f"unexpected visible steps {visible}")
    return store.read("dwh.f01_customer_orders")


# -- final tables -----------------------------------------------------------

def _clean_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _t(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        *[F.col(c).cast(fx.MONEY).alias(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")],
        "l_returnflag", "l_linestatus", "l_shipdate",
    )
    return keep_latest(lines, ["l_orderkey", "l_linenumber"], ["-l_shipdate"])


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_lines(
        _clean_lines(spark, sf_dir),
        _t(spark, sf_dir, "orders"),
        _t(spark, sf_dir, "customer"),
        _t(spark, sf_dir, "part"),
        _t(spark, sf_dir, "supplier"),
    )


def dwh_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark, "dwh_fact")
    store.refresh(_fact(spark, sf_dir), "dwh.fact_lines", layer="dwh")
    return store.read("dwh.fact_lines").withColumn("revenue", F.col("revenue").cast("decimal(18,4)"))


def dwh_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = segment_month_report(
        _clean_lines(spark, sf_dir), _t(spark, sf_dir, "orders"), _t(spark, sf_dir, "customer")
    )
    return report.select(
        "c_mktsegment",
        "order_month",
        F.col("line_count").cast("bigint").alias("line_count"),
        F.col("sum_qty").cast("decimal(38,2)").alias("sum_qty"),
        F.col("revenue").cast("decimal(38,4)").alias("revenue"),
    )


def fact_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that miss a side of the fact when some orders, customers, parts and suppliers have not come yet."""
    arrived = lambda name, key, n: _t(spark, sf_dir, name).filter(F.col(key) % n != 0)
    return unmatched_lines(
        _t(spark, sf_dir, "lineitem"),
        arrived("orders", "o_orderkey", 40),
        arrived("customer", "c_custkey", 30),
        arrived("part", "p_partkey", 25),
        arrived("supplier", "s_suppkey", 9),
    )


LINE_COLUMNS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
LINE_SIDES = (
    Side("erp.orders", "o_orderkey", "l_orderkey", ("o_custkey", "o_orderdate")),
    Side("erp.customer", "c_custkey", "o_custkey", ("c_nationkey",)),
    Side("erp.part", "p_partkey", "l_partkey", ("p_brand",)),
    Side("erp.supplier", "s_suppkey", "l_suppkey", ("s_nationkey",)),
)


def early_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines in two loads, their dimensions in three, some rows late, some never; every line with what it still misses."""
    store, fact = _store(spark, "early_facts"), "dwh.lines"
    arrivals = lambda side: fx.arrivals(_t(spark, sf_dir, side.table.split(".")[1]), side.key)
    lines = _t(spark, sf_dir, "lineitem").select(*LINE_COLUMNS)
    for arrival in range(3):
        for side in LINE_SIDES:
            store.append(arrivals(side)[arrival], side.table, layer="stg")
        if store.exists(fact):
            place_parked(store, fact, LINE_COLUMNS, LINE_SIDES)
        if arrival < 2:
            load_lines(store, fact, lines.filter(F.col("l_partkey") % 2 == arrival), LINE_SIDES)
    placed = placed_lines(store, fact).withColumn("missing", F.lit(None).cast("string"))
    return placed.unionByName(parked_lines(store, fact).withColumnRenamed("_missing", "missing"))


def orphan_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept_orders = _t(spark, sf_dir, "orders").filter(F.col("o_orderkey") % 50 != 0)
    return orphans(_t(spark, sf_dir, "lineitem"), kept_orders, "l_orderkey", "o_orderkey")


def content_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders against a copy of equal counts with single cells changed: the cells."""
    orders = _t(spark, sf_dir, "orders")
    return content_differences(orders, fx.order_cells_changed(orders), ["o_orderkey"], buckets=256).drop("copies")


def report_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by status and year, kept by what two further snapshots change; the table isn't summed again."""
    store = _store(spark, "report_deltas")
    dimensions = {"o_orderstatus": F.col("o_orderstatus"), "o_year": F.year("o_orderdate")}
    first, second = fx.order_snapshots(_t(spark, sf_dir, "orders"))
    for snapshot in (first, second.filter("o_orderkey % 3 <> 0"), second):
        load_snapshot(store, snapshot, "erp_stg.orders", ["o_orderkey"], buckets=16, source="erp")
        keep_report(store, "erp_stg.orders", "dwh.orders_by_status", dimensions, ["o_totalprice"])
    return store.read("dwh.orders_by_status")


def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of three sources numbered in two loads (a third brings nothing new); orders counted by number."""
    store = _store(spark, "surrogate_keys")
    sources = F.element_at(F.array(*[F.lit(n) for n in fx.SOURCE_NAMES]), (F.col("o_orderkey") % 3 + 1).cast("int"))
    orders = _t(spark, sf_dir, "orders").select(sources.alias("source"), "o_custkey", "o_orderkey")
    for rows in (orders.filter(fx.FIRST_ORDERS), orders, orders):
        extend_key_map(store, rows, "dwh.customer_keys", ["source", "o_custkey"], name="customer_sk")
    numbered = with_surrogate(orders, store.read("dwh.customer_keys"), ["source", "o_custkey"], "customer_sk")
    return numbered.groupBy("source", "o_custkey", "customer_sk").agg(F.count("*").alias("order_count"))


CUSTOMER_MATCHES = (MatchRule(("nation",), "name"), MatchRule(("tax_no",)))


def matched_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of three sources, one row for each: matched by name (one edit) in a nation or by tax number."""
    records = fx.customers_of_sources(_t(spark, sf_dir, "customer"))
    entities = match_entities(records, "record_id", CUSTOMER_MATCHES)
    return surviving_records(records, entities, "record_id", "trust", ["name", "nation", "tax_no", "segment"])


def _order_changes_of_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus", "o_orderkey")


def dimension_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Priority and status of customers over time, from their orders, which come in two loads (the second brings late ones)."""
    changes = _order_changes_of_customers(spark, sf_dir)
    first = changes.filter(fx.FIRST_ORDERS)
    second = changes.filter(~F.expr(fx.FIRST_ORDERS))
    of = (["o_custkey"], "o_orderdate", ["o_orderpriority", "o_orderstatus"])
    store, log, target = _store(spark, "dimension_history"), "dwh.customer_changes", "dwh.customer_history"
    store.append(first, log, layer="dwh")
    store.refresh(validity(store.read(log), *of), target, layer="dwh")
    store.append(second, log, layer="dwh")
    known = store.read(target)
    store.publish(lambda: close_and_open(known, store.read(log), second, *of), target, "upsert", layer="dwh")
    return store.read(target)


def fact_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with their customer's priority and status at the time of shipping."""
    changes = _order_changes_of_customers(spark, sf_dir)
    attributes = ["o_orderpriority", "o_orderstatus"]
    history = validity(changes, ["o_custkey"], "o_orderdate", attributes)
    lines = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    # Every fortieth order has not come yet, so its lines have no customer.
    owners = changes.filter("o_orderkey % 40 <> 0").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return as_of(lines.join(owners, "l_orderkey", "left"), history, ["o_custkey"], "l_shipdate", attributes)


def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders kept by order year; the change set rewrites only the years it touches."""
    store = _store(spark, "upsert_latest")
    by_year = lambda df: df.withColumn("o_year", F.year("o_orderdate"))
    orders = _t(spark, sf_dir, "orders")
    store.refresh(by_year(orders), "dwh.orders", layer="dwh", partition_by=["o_year"])
    store.upsert(by_year(fx.order_changes(orders)), "dwh.orders", ["o_orderkey"], layer="dwh",
                 partition_column="o_year")
    return store.read("dwh.orders").drop("o_year")


def upsert_unkeyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders, some without a key, loaded three times by increments that read their last days again."""
    store = _store(spark, "upsert_unkeyed")
    orders = fx.orders_without_keys(_t(spark, sf_dir, "orders"))
    for _ in range(3):
        load_increment(store, orders, "erp_stg.orders", keys=["o_orderkey"], column="o_orderdate",
                       lookback=dt.timedelta(days=400), merge="upsert", source="erp")
    return store.read("erp_stg.orders")


QUERIES: dict[str, Query] = {
    "pipeline_report": pipeline_report,
    "extract_query": extract_query,
    "extract_catalog": extract_catalog,
    "multi_source_stage": multi_source_stage,
    "incremental_hwm": incremental_hwm,
    "incremental_stream": incremental_stream,
    "snapshot_diff": snapshot_diff,
    "load_append": load_append,
    "full_refresh": full_refresh,
    "load_audit": load_audit,
    "stage_as_text": stage_as_text,
    "cast_int": cast_int,
    "cast_decimal": cast_decimal,
    "cast_boolean": cast_boolean,
    "cast_timestamp": cast_timestamp,
    "typed_accepted": typed_accepted,
    "reject_rows": reject_rows,
    "incremental_transform": incremental_transform,
    "landed_pipeline": landed_pipeline,
    "repaired_rejects": repaired_rejects,
    "type_profile": type_profile,
    "dedup_exact": dedup_exact,
    "dedup_latest": dedup_latest,
    "reconcile": reconcile,
    "run_steps": run_steps_query,
    "step_isolation": step_isolation,
    "dwh_fact": dwh_fact,
    "dwh_report": dwh_report,
    "fact_unmatched": fact_unmatched,
    "early_facts": early_facts,
    "orphan_rows": orphan_rows,
    "upsert_latest": upsert_latest,
    "upsert_unkeyed": upsert_unkeyed,
    "content_check": content_check,
    "report_deltas": report_deltas,
    "surrogate_keys": surrogate_keys,
    "matched_entities": matched_entities,
    "dimension_history": dimension_history,
    "fact_as_of": fact_as_of,
}

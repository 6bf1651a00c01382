"""Final tables: a line fact with its dimensions, reports, orphan checks.

No join carries a hint: Spark broadcasts a dimension while its run-time size is
within the limit and joins by shuffle beyond it. Reports aggregate as early as the keys allow: lines are
summed per order before they meet ``orders``, and per (customer, year) before
they meet ``customer``, because every later shuffle then moves one row per
group instead of one per line (Catalyst does not push aggregates below joins).
Decimal sums are exact, so re-aggregating partial sums changes no value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def line_revenue() -> F.Column:
    return F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount"))


def fact_lines(
    lines: DataFrame,
    orders: DataFrame,
    customer: DataFrame,
    part: DataFrame,
    supplier: DataFrame,
) -> DataFrame:
    """One row per line with order date/status, customer segment and nation,
    part brand/type, supplier nation, and measures."""
    # Customers meet the orders first: the lines are shuffled by order, part and supplier only.
    # Orders come last: the lines then stay spread over the cores that the smaller joins left them on.
    o = orders.select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate", "o_orderstatus"
    ).join(customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_nationkey"), "o_custkey")
    p = part.select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type")
    s = supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    f = (
        lines.select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
            "l_extendedprice", "l_discount", "l_shipdate",
        )
        .join(p, "l_partkey")
        .join(s, "l_suppkey")
        .join(o, "l_orderkey")
    )
    return f.select(
        "l_orderkey", "l_linenumber",
        F.col("o_custkey").alias("c_custkey"), "c_mktsegment", "c_nationkey",
        F.col("l_partkey").alias("p_partkey"), "p_brand", "p_type",
        F.col("l_suppkey").alias("s_suppkey"), "s_nationkey",
        "o_orderdate", "o_orderstatus", "l_shipdate",
        "l_quantity", "l_extendedprice", "l_discount",
        line_revenue().alias("revenue"),
    )


def unmatched_lines(
    lines: DataFrame, orders: DataFrame, customer: DataFrame, part: DataFrame, supplier: DataFrame
) -> DataFrame:
    """Lines that :func:`fact_lines` can't place, with the first side they miss: order, customer, part, supplier."""
    there = lambda df, key, to, flag: df.select(F.col(key).alias(to), F.lit(True).alias(flag)).distinct()
    o = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", F.lit(True).alias("_order")).join(
        there(customer, "c_custkey", "o_custkey", "_customer"), "o_custkey", "left"
    )
    found = (
        lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
        .join(o.drop("o_custkey"), "l_orderkey", "left")
        .join(there(part, "p_partkey", "l_partkey", "_part"), "l_partkey", "left")
        .join(there(supplier, "s_suppkey", "l_suppkey", "_supplier"), "l_suppkey", "left")
    )
    missing = F.lit(None).cast("string")
    for side in ("supplier", "part", "customer", "order"):
        missing = F.when(F.col(f"_{side}").isNull(), side).otherwise(missing)
    return found.withColumn("missing", missing).filter("missing is not null").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "missing"
    )


def segment_month_report(lines: DataFrame, orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Lines, quantity and revenue by segment and order month: summed per order before any join."""
    per_order = lines.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("line_count"),
        F.sum("l_quantity").alias("sum_qty"),
        F.sum(line_revenue()).alias("revenue"),
    )
    o = orders.select(
        F.col("o_orderkey").alias("l_orderkey"),
        "o_custkey",
        F.trunc(F.to_date("o_orderdate"), "month").alias("order_month"),
    )
    c = customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return (
        per_order.join(o, "l_orderkey")
        .join(c, "o_custkey")
        .groupBy("c_mktsegment", "order_month")
        .agg(
            F.sum("line_count").alias("line_count"),
            F.sum("sum_qty").alias("sum_qty"),
            F.sum("revenue").alias("revenue"),
        )
    )


def revenue_by_nation_year(
    lines: DataFrame, orders: DataFrame, customer: DataFrame, nation: DataFrame
) -> DataFrame:
    per_order = lines.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("line_count"),
        F.sum("l_quantity").alias("sum_qty"),
        F.sum(line_revenue()).alias("revenue"),
    )
    o = orders.select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", F.year("o_orderdate").alias("o_year")
    )
    per_customer_year = (
        per_order.join(o, "l_orderkey")
        .groupBy("o_custkey", "o_year")
        .agg(
            F.sum("line_count").alias("line_count"),
            F.sum("sum_qty").alias("sum_qty"),
            F.sum("revenue").alias("revenue"),
        )
    )
    c = customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    n = nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return (
        per_customer_year.join(c, "o_custkey")
        .join(n, "c_nationkey")
        .groupBy("n_name", "o_year")
        .agg(
            F.sum("line_count").alias("line_count"),
            F.sum("sum_qty").alias("sum_qty"),
            F.sum("revenue").alias("revenue"),
        )
    )


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Rows of ``child`` whose ``child_key`` has no row in ``parent`` (only the key is shuffled)."""
    keys = parent.select(F.col(parent_key).alias(child_key))
    return child.join(keys, child_key, "left_anti")

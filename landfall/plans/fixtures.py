"""Derived test inputs: pure expressions over the driver's tables.

Each rule here has a twin in :mod:`landfall.plans.oracles` stated in DuckDB
SQL, so both engines see the same dirty text, sources and change sets.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.operators.typed import ColumnSpec
from landfall.plans.layers import TableRule

# Corruption of the dirty lineitem staging, as
# (column, l_orderkey modulus, text put in its place).
DIRTY_RULES = (
    ("l_quantity", 97, "n/a"),
    ("l_extendedprice", 101, "1,000"),
    ("l_partkey", 103, "3.7"),
    ("l_discount", 107, ""),
    ("l_shipdate", 109, "2024-02-30"),
)

# Boolean words by c_custkey % 8.
BOOLEAN_WORDS = ("true", "FALSE", "y", "n", "1", "0", "on", "maybe")

# Date text patterns by o_orderkey % 3 (0: ISO date-time, 1: ISO date, 2: day.month.year).
DATE_TEXT_FORMATS = (None, "yyyy-MM-dd", "dd.MM.yyyy")

# Source names by o_orderkey % 3.
SOURCE_NAMES = ("a", "b", "c")

MONEY = "decimal(12,2)"

LINEITEM_RULE = TableRule(
    "lineitem",
    specs=(
        ColumnSpec("l_orderkey", "bigint", nullable=False),
        ColumnSpec("l_partkey", "bigint"),
        ColumnSpec("l_suppkey", "bigint"),
        ColumnSpec("l_linenumber", "int", nullable=False),
        ColumnSpec("l_quantity", MONEY),
        ColumnSpec("l_extendedprice", MONEY),
        ColumnSpec("l_discount", MONEY),
        ColumnSpec("l_tax", MONEY),
        ColumnSpec("l_returnflag", "string"),
        ColumnSpec("l_linestatus", "string"),
        ColumnSpec("l_shipdate", "timestamp", formats=("iso", "dd.MM.yyyy")),
    ),
    keys=("l_orderkey", "l_linenumber"),
    order=("-l_shipdate",),
)

ORDERS_RULE = TableRule(
    "orders",
    specs=(
        ColumnSpec("o_orderkey", "bigint", nullable=False),
        ColumnSpec("o_custkey", "bigint"),
        ColumnSpec("o_orderstatus", "string"),
        ColumnSpec("o_totalprice", MONEY),
        ColumnSpec("o_orderdate", "timestamp", formats=("iso", "dd.MM.yyyy")),
        ColumnSpec("o_orderpriority", "string"),
    ),
    keys=("o_orderkey",),
)

CUSTOMER_RULE = TableRule(
    "customer",
    specs=(
        ColumnSpec("c_custkey", "bigint", nullable=False),
        ColumnSpec("c_name", "string"),
        ColumnSpec("c_nationkey", "int"),
        ColumnSpec("c_acctbal", MONEY),
        ColumnSpec("c_mktsegment", "string"),
    ),
    keys=("c_custkey",),
)

NATION_RULE = TableRule(
    "nation",
    specs=(
        ColumnSpec("n_nationkey", "int", nullable=False),
        ColumnSpec("n_name", "string"),
        ColumnSpec("n_regionkey", "int"),
    ),
    keys=("n_nationkey",),
)


def dirty_lineitem(lineitem: DataFrame) -> DataFrame:
    """``lineitem`` as staged text with the :data:`DIRTY_RULES` corruption."""
    key = F.col("l_orderkey")
    cols = []
    for c in lineitem.columns:
        expr = F.col(c).cast("string")
        for column, modulus, bad in DIRTY_RULES:
            if column == c:
                expr = F.when(key % modulus == 0, F.lit(bad)).otherwise(expr)
        cols.append(expr.alias(c))
    return lineitem.select(*cols)


# Date formats that a profile looks for.
PROFILE_FORMATS = ("iso", "dd.MM.yyyy", "MM/dd/yyyy")

#: The lines' rule once a third date format is known.
REPAIRED_RULE = replace(
    LINEITEM_RULE,
    specs=tuple(
        replace(s, formats=(*s.formats, "MM/dd/yyyy")) if s.name == "l_shipdate" else s for s in LINEITEM_RULE.specs
    ),
)


def lines_with_slashed_dates(dirty: DataFrame) -> DataFrame:
    """Dirty lines, the dates of every fifth order (``% 5 = 2``) written as month/day/year."""
    slashed = F.date_format(F.col("l_shipdate").try_cast("timestamp_ntz"), "MM/dd/yyyy")
    changed = F.when(F.col("l_orderkey").cast("bigint") % 5 == 2, F.coalesce(slashed, "l_shipdate"))
    return dirty.withColumn("l_shipdate", F.coalesce(changed, "l_shipdate"))


def load_of_line() -> F.Column:
    """The load (0 to 2) that a dirty line comes with: by its supplier, so that lines of one key come with several."""
    return F.col("l_suppkey").cast("bigint") % 3


def boolean_text(customer: DataFrame) -> DataFrame:
    word = F.element_at(F.array(*[F.lit(w) for w in BOOLEAN_WORDS]), (F.col("c_custkey") % 8 + 1).cast("int"))
    return customer.select("c_custkey", word.alias("raw_value"))


def date_text(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey") % 3
    text = (
        F.when(k == 0, F.col("o_orderdate").cast("string"))
        .when(k == 1, F.date_format("o_orderdate", DATE_TEXT_FORMATS[1]))
        .otherwise(F.date_format("o_orderdate", DATE_TEXT_FORMATS[2]))
    )
    return orders.select("o_orderkey", text.alias("raw_value"))


def source_query(k: int) -> str:
    return f"select * from orders where o_orderkey % 3 = {k}"


def first_event_load(events: DataFrame) -> DataFrame:
    """Events before 16 January, without the late rows of 13–15 January with ``event_id % 10 = 0``."""
    late = (F.col("ts") >= F.lit("2024-01-13").cast("timestamp_ntz")) & (F.col("event_id") % 10 == 0)
    return events.filter((F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")) & ~late)


# Fixed value: the orders of a first load; the others, late ones among them, come with a second.
FIRST_ORDERS = "o_orderkey % 4 <> 1"


def order_snapshots(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Orders before and after: some come (``% 997 = 1``), some go (``% 991 = 2``), some change (``% 983 = 3``)."""
    key = F.col("o_orderkey")
    before = orders.filter(key % 997 != 1)
    status = F.when(key % 983 == 3, F.lit("X")).otherwise(F.col("o_orderstatus"))
    customer = F.when((key % 983 == 3) & (key % 2 == 1), F.col("o_custkey") + 1).otherwise(F.col("o_custkey"))
    after = orders.filter(key % 991 != 2).withColumn("o_orderstatus", status).withColumn("o_custkey", customer)
    return before, after


def order_cells_changed(orders: DataFrame) -> DataFrame:
    """One cell changed in some rows: customer (``% 500 = 7``), status made NULL (``% 700 = 9``); one row replaced (``% 900 = 4``)."""
    key = F.col("o_orderkey")
    return orders.select(
        F.when(key % 900 == 4, -key).otherwise(key).alias("o_orderkey"),
        F.when(key % 500 == 7, F.col("o_custkey") + 1).otherwise(F.col("o_custkey")).alias("o_custkey"),
        F.when(key % 700 != 9, F.col("o_orderstatus")).alias("o_orderstatus"),
        "o_totalprice", "o_orderdate", "o_orderpriority",
    )


def orders_without_keys(orders: DataFrame) -> DataFrame:
    """Every twentieth order without its key."""
    return orders.withColumn("o_orderkey", F.when(F.col("o_orderkey") % 20 != 0, F.col("o_orderkey")))


def arrivals(dimension: DataFrame, key: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A dimension in three loads: most rows, those of ``% 7 = 3``, those of ``% 11 = 5``; ``% 13 = 6`` never come."""
    k = F.col(key)
    there = dimension.filter(k % 13 != 6)
    second, third = k % 7 == 3, k % 11 == 5
    return there.filter(~second & ~third), there.filter(second & ~third), there.filter(third)


def customers_of_sources(customer: DataFrame) -> DataFrame:
    """Customers as three sources know them: ``crm`` all, ``shop`` every second with a character of the name
    replaced, ``web`` every third with one left out; some share a tax number with the fifth customer after."""
    key = F.col("c_custkey").cast("bigint")
    code = F.md5(key.cast("string"))
    part = lambda at, n: F.substring(code, at, n)
    place = (key % 12 + 1).cast("int")
    short = F.substring(code, 1, 12)
    cut = lambda put, skip: F.concat(
        F.substring(short, F.lit(1), place - 1), F.lit(put), F.substring(short, place + skip, F.lit(12))
    )
    tax = F.when(key % 5 == 0, F.concat(F.lit("DE-"), (key - key % 10).cast("string")))
    segment = F.col("c_mktsegment")

    def rows(number, source, name, tax_no, market):
        return customer.select(
            (key * 4 + number).alias("record_id"), F.lit(source).alias("source"), F.lit(number).alias("trust"),
            name.alias("name"), F.col("c_nationkey").cast("int").alias("nation"), tax_no.alias("tax_no"),
            market.alias("segment"), key.alias("_key"),
        )

    crm = rows(0, "crm", F.concat(part(1, 6), F.lit(" "), F.upper(part(7, 6))), tax, F.when(key % 7 != 0, segment))
    shop = rows(1, "shop", cut("X", 1), F.lit(None).cast("string"), F.when(key % 4 != 0, segment)).filter("_key % 2 = 0")
    web = rows(2, "web", cut("", 1), F.lower(tax), F.lower(segment)).filter("_key % 3 = 0")
    return crm.union(shop).union(web).drop("_key")


def order_changes(orders: DataFrame) -> DataFrame:
    """Every tenth order changed: status ``X``, price + 1."""
    return orders.filter(F.col("o_orderkey") % 10 == 0).select(
        "o_orderkey",
        "o_custkey",
        F.lit("X").alias("o_orderstatus"),
        (F.col("o_totalprice") + F.lit(1.0)).alias("o_totalprice"),
        "o_orderdate",
        "o_orderpriority",
    )

"""What staged text holds: one pass that counts, per column, which types its values fit, and proposes a typing rule.

The state of a column is sums and maxima only, so states of parts of a table
(days, sources, files) merge in any order to the state of the whole. Every
value is a row of its column's group, so the plan does not grow with the
columns. The
proposal is the narrowest type that takes every value that is not blank::

    int < bigint < decimal(p,s) < string,   boolean < string,   timestamp < string

Whole numbers written with leading zeros are codes and stay text. A column of
blanks, or of numbers wider than 38 digits, is text. 0 and 1 alone are
integers, since every such column fits both.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.functions.casts import ISO, is_blank, parse_boolean, parse_int, parse_timestamp
from landfall.operators.typed import ColumnSpec

_NUMBER = r"^[+-]?([0-9]+)([.]([0-9]+))?$"
_LED_BY_ZERO = r"^[+-]?0[0-9]"
SUMS = ("row_count", "blanks", "ints", "bigints", "decimals", "led_by_zero", "booleans", "timestamps")
MAXIMA = ("whole_digits", "scale", "longest")


def _count(c: Column) -> Column:
    return F.count(F.when(c, 1))


def _state(raw: Column, formats: Sequence[str]) -> list[Column]:
    text = F.trim(raw)
    number = text.rlike(_NUMBER)
    whole = F.regexp_replace(F.regexp_extract(text, _NUMBER, 1), "^0+", "")
    parsed = [parse_timestamp(raw, (f,)).isNotNull() for f in formats]
    any_date = reduce(lambda a, b: a | b, parsed)
    return [
        F.count(F.lit(1)).alias("row_count"),
        _count(is_blank(raw)).alias("blanks"),
        _count(parse_int(raw, "int").isNotNull()).alias("ints"),
        _count(parse_int(raw, "bigint").isNotNull()).alias("bigints"),
        _count(number).alias("decimals"),
        _count(text.rlike(_LED_BY_ZERO)).alias("led_by_zero"),
        _count(parse_boolean(raw).isNotNull()).alias("booleans"),
        _count(any_date).alias("timestamps"),
        F.coalesce(F.max(F.when(number, F.length(whole))), F.lit(0)).cast("bigint").alias("whole_digits"),
        F.coalesce(F.max(F.when(number, F.length(F.regexp_extract(text, _NUMBER, 3)))), F.lit(0)).cast("bigint").alias("scale"),
        F.coalesce(F.max(F.length(raw)), F.lit(0)).cast("bigint").alias("longest"),
        F.array(*[_count(p) for p in parsed]).alias("by_format"),
    ]


def profile_text(staged: DataFrame, formats: Sequence[str] = (ISO,)) -> DataFrame:
    """One row per column of ``staged``: its state (:data:`SUMS`, :data:`MAXIMA`, ``by_format`` in the order of ``formats``)."""
    names = staged.columns
    values = staged.select(F.posexplode(F.array(*[F.col(f"`{c}`").cast("string") for c in names])).alias("place", "raw"))
    fields = (*SUMS, *MAXIMA, "by_format")
    state = F.struct(*fields)
    found = values.groupBy("place").agg(*_state(F.col("raw"), formats)).select("place", state.alias("state"))
    held = F.map_from_entries(F.collect_list(F.struct("place", "state"))).alias("held")
    zero = F.lit(0).cast("bigint")
    none = F.struct(*[zero.alias(f) for f in fields[:-1]], F.array(*[zero] * len(formats)).alias("by_format"))
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.coalesce(F.col("held")[i], none).alias("state"))  # a table without rows
        for i, c in enumerate(names)
    ]
    return found.agg(held).select(F.inline(F.array(*rows))).select("column_name", "state.*")


def merge_profiles(states: DataFrame, formats: Sequence[str] = (ISO,)) -> DataFrame:
    """States of parts (their union) merged to the state of the whole."""
    by_format = F.array(*[F.sum(F.get("by_format", F.lit(i))) for i in range(len(formats))])
    return states.groupBy("column_name").agg(
        *[F.sum(c).alias(c) for c in SUMS], *[F.max(c).alias(c) for c in MAXIMA], by_format.alias("by_format")
    )


def proposed_type() -> Column:
    """The narrowest type of a column, from its state."""
    there = F.col("row_count") - F.col("blanks")
    digits = F.greatest(F.col("whole_digits"), F.lit(1)) + F.col("scale")
    decimal = F.concat(F.lit("decimal("), digits.cast("string"), F.lit(","), F.col("scale").cast("string"), F.lit(")"))
    code = F.col("led_by_zero") > 0
    return (
        F.when(there == 0, "string")
        .when((F.col("ints") == there) & ~code, "int")
        .when((F.col("bigints") == there) & ~code, "bigint")
        .when((F.col("decimals") == there) & ~((F.col("scale") == 0) & code) & (digits <= 38), decimal)
        .when(F.col("booleans") == there, "boolean")
        .when(F.col("timestamps") == there, "timestamp")
        .otherwise("string")
    )


def propose_specs(states: DataFrame, formats: Sequence[str] = (ISO,), not_null: Sequence[str] = ()) -> list[ColumnSpec]:
    """Column specs that reject none of the profiled values; formats that occur, the commonest first.

    ``not_null`` columns are declared so only if none of their values is blank.
    The driver holds one row per column.
    """
    specs = []
    for r in states.withColumn("_type", proposed_type()).collect():
        used = sorted((i for i, n in enumerate(r.by_format) if n), key=lambda i: (-r.by_format[i], i))
        kept = tuple(formats[i] for i in used) if r["_type"] == "timestamp" else (ISO,)
        nullable = not (r.column_name in not_null and r.blanks == 0)
        specs.append(ColumnSpec(r.column_name, r["_type"], kept, nullable))
    return specs

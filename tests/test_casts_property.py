"""Parsers against plain-Python statements of the same rules, on generated text."""

import re
from decimal import ROUND_HALF_UP, Decimal, InvalidOperation

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from landfall.functions.casts import FALSE_WORDS, TRUE_WORDS, parse_boolean, parse_decimal, parse_int

TEXT = st.text(alphabet="0123456789+-. eE,xaTrufsYNO", max_size=12)
LONG_MIN, LONG_MAX = -(2**63), 2**63 - 1


def ref_int(v):
    if v is None:
        return None
    t = v.strip(" ")
    if not re.fullmatch(r"[+-]?[0-9]+", t):
        return None
    n = int(t)
    return n if LONG_MIN <= n <= LONG_MAX else None


def ref_decimal(v, precision=12, scale=2):
    if v is None:
        return None
    t = v.strip(" ")
    if not re.fullmatch(r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?", t):
        return None
    try:
        d = Decimal(t).quantize(Decimal(1).scaleb(-scale), rounding=ROUND_HALF_UP)
    except InvalidOperation:
        return None
    return d if len(d.as_tuple().digits) - max(0, -d.as_tuple().exponent - scale) <= precision and abs(d) < Decimal(10) ** (precision - scale) else None


def ref_bool(v):
    if v is None:
        return None
    w = v.strip(" ").lower()
    return True if w in TRUE_WORDS else False if w in FALSE_WORDS else None


def run(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return {r["i"]: r["x"] for r in df.select("i", expr(F.col("v")).alias("x")).collect()}


@settings(max_examples=8, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=150))
def test_parse_int_matches_rule(spark, values):
    got = run(spark, values, lambda c: parse_int(c, "bigint"))
    assert [got[i] for i in range(len(values))] == [ref_int(v) for v in values]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.from_regex(r"[+-]?[0-9]{0,12}(\.[0-9]{0,4})?", fullmatch=True), min_size=1, max_size=150))
def test_parse_decimal_matches_rule(spark, values):
    got = run(spark, values, lambda c: parse_decimal(c, 12, 2))
    assert [got[i] for i in range(len(values))] == [ref_decimal(v) for v in values]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.sampled_from(list(TRUE_WORDS + FALSE_WORDS) + ["TRUE", " Yes ", "On", "maybe", "2", "", "nope"]),
                min_size=1, max_size=60))
def test_parse_boolean_matches_rule(spark, values):
    got = run(spark, values, parse_boolean)
    assert [got[i] for i in range(len(values))] == [ref_bool(v) for v in values]

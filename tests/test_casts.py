import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from landfall.functions.casts import parse_boolean, parse_decimal, parse_int, parse_timestamp


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "v string").select(expr(F.col("v")).alias("x")).first()["x"]


@pytest.mark.parametrize(
    "text,expected",
    [(" 2 ", 2), ("+5", 5), ("-5", -5), ("3.7", None), ("3.0", None), ("1e3", None), ("0x10", None),
     ("2147483648", None), ("", None), ("  ", None), (None, None)],
)
def test_parse_int(spark, text, expected):
    assert one(spark, lambda c: parse_int(c, "int"), text) == expected


def test_parse_bigint_takes_large(spark):
    assert one(spark, lambda c: parse_int(c, "bigint"), "2147483648") == 2147483648


@pytest.mark.parametrize(
    "text,expected",
    [("1.005", Decimal("1.01")), ("2.675", Decimal("2.68")), ("1e3", Decimal("1000.00")),
     ("12345678901.239", None), ("1,000", None), ("n/a", None), ("", None)],
)
def test_parse_decimal(spark, text, expected):
    assert one(spark, lambda c: parse_decimal(c, 12, 2), text) == expected


@pytest.mark.parametrize(
    "text,expected",
    [("true", True), ("TRUE", True), ("t", True), ("yes", True), ("y", True), ("1", True), ("on", True),
     ("no", False), ("n", False), ("0", False), ("f", False), ("FALSE", False), ("off", False),
     ("maybe", None), ("2", None), ("", None)],
)
def test_parse_boolean(spark, text, expected):
    assert one(spark, parse_boolean, text) == expected


@pytest.mark.parametrize(
    "text,expected",
    [("2024-01-05 10:11:12", dt.datetime(2024, 1, 5, 10, 11, 12)), ("2024-01-05", dt.datetime(2024, 1, 5)),
     ("2024-1-5", dt.datetime(2024, 1, 5)), ("05.01.2024", dt.datetime(2024, 1, 5)),
     ("2024-02-30", None), ("junk", None), ("", None)],
)
def test_parse_timestamp(spark, text, expected):
    assert one(spark, lambda c: parse_timestamp(c, ("iso", "dd.MM.yyyy")), text) == expected


def test_timestamp_without_pattern_rejects_dotted(spark):
    assert one(spark, parse_timestamp, "05.01.2024") is None


def test_timestamp_type_is_ntz(spark):
    df = spark.createDataFrame([("2024-01-05",)], "v string").select(parse_timestamp("v").alias("x"))
    assert df.schema["x"].dataType.simpleString() == "timestamp_ntz"


def test_shapes_of_patterns_leave_out_nothing_that_parses(spark):
    from landfall.functions import casts

    patterns = ["dd.MM.yyyy", "d/M/yyyy", "yyyyMMdd", "dd MMM yyyy", "yyyy-MM-dd HH:mm:ss", "dd.MM.yyyy'T'HH:mm", "yyyy[-MM]-dd", "yyyy_MM%dd", "HH:mm dd.MM.yyyy"]
    texts = ["01.02.2024", " 01.02.2024 ", "1/2/2024", "20240102", "02 Jan 2024", "02 jan 2024", "2024-01-02 03:04:05", "02.01.2024T03:04", "2024-01-02",
             "2024_01%02", "03:04 02.01.2024", "31.02.2024", "99.99.9999", "1.25", "-100", "+12024.01.01", "01.02.+12024", "01.02.12024", "x", "", " ", "1,000", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for p in patterns:
        text = F.trim("t")
        plain = F.try_to_timestamp(text, F.lit(p)) if casts._has_time(p) else F.try_to_date(text, p)
        pairs = df.select(casts.parse_timestamp("t", (p,)).cast("string"), plain.cast("timestamp_ntz").cast("string")).collect()
        assert [a for a, _ in pairs] == [b for _, b in pairs], p
    assert casts._shape("dd.MM.yyyy") and casts._shape("yyyy[-MM]") is None

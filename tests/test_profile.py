"""Profiles of staged text: merged states equal the whole's, proposed rules reject nothing."""

import itertools

from landfall.operators.profile import merge_profiles, profile_text, proposed_type, propose_specs
from landfall.operators.typed import apply_types

FORMATS = ("iso", "dd.MM.yyyy")
COLUMNS = "i string, l string, d string, b string, t string, code string, s string, blank string, `odd.name` string"
ROWS = [
    ("1", "3000000000", "1.25", "yes", "2024-01-01", "007", "x", None, "1"),
    (" -7 ", "2", "-100", "off", "02.01.2024", "12", "1", " ", "0"),
    ("", None, "0.001", "T", "03.01.2024", "1", "2024-01-01", "", "1"),
    ("+5", "0", "12345.6", None, "04.01.2024", "", "", None, None),
]
TYPES = {
    "i": "int", "l": "bigint", "d": "decimal(8,3)", "b": "boolean", "t": "timestamp", "code": "string",
    "s": "string", "blank": "string", "odd.name": "int",
}


def state(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


def test_parts_merge_in_any_order(spark):
    df = spark.createDataFrame(ROWS, COLUMNS)
    whole = state(profile_text(df, FORMATS))
    parts = [profile_text(spark.createDataFrame(rows, COLUMNS), FORMATS) for rows in (ROWS[:1], ROWS[1:3], ROWS[3:], [])]
    for order in list(itertools.permutations(parts))[::7]:
        merged = order[0].union(order[1]).union(order[2]).union(order[3])
        assert state(merge_profiles(merged, FORMATS)) == whole


def test_proposed_rules_reject_nothing(spark):
    df = spark.createDataFrame(ROWS, COLUMNS)
    profile = profile_text(df, FORMATS)
    assert {r.column_name: r.p for r in profile.withColumn("p", proposed_type()).collect()} == TYPES
    specs = {s.name: s for s in propose_specs(profile, FORMATS, not_null=["l", "t"])}
    assert specs["t"].formats == ("dd.MM.yyyy", "iso") and not specs["t"].nullable and specs["l"].nullable
    typed = apply_types(df.drop("odd.name"), [s for n, s in specs.items() if n != "odd.name"])
    assert typed.filter("_rejected").count() == 0
    assert {str(r.t)[:10] for r in typed.collect()} == {"2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"}


def test_the_plan_of_a_profile_does_not_grow_with_its_columns(spark):
    def aggregates(columns):
        df = spark.createDataFrame([], ", ".join(f"c{i} string" for i in range(columns)))
        return profile_text(df, FORMATS)._jdf.queryExecution().optimizedPlan().toString().count("count(")

    assert aggregates(2) == aggregates(30)


def test_an_empty_table_is_text(spark):
    profile = profile_text(spark.createDataFrame([], COLUMNS), FORMATS)
    assert {r.p for r in profile.select(proposed_type().alias("p")).collect()} == {"string"}
    wide = spark.createDataFrame([("9" * 39,), ("9" * 20,)], "w string")
    assert profile_text(wide).select(proposed_type()).first()[0] == "string"
    assert profile_text(wide.filter("length(w) < 30")).select(proposed_type()).first()[0] == "decimal(20,0)"

"""Typed layer: staged text → typed columns, with every failed value kept.

All checks are built in one projection as an array of reject entries, so each
staged row is read once. A row with an empty array is accepted; the others are
rejected rows, and exploding the array gives one reject entry per bad value.
Nothing is dropped silently: accepted + rejected = read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.functions.casts import ISO, is_blank, parse_as

REJECTS = "_rejects"
REJECTED = "_rejected"

REJECT_ENTRY = "struct<column_name:string,raw_value:string,expected_type:string>"


@dataclass(frozen=True)
class ColumnSpec:
    """Target type of one staged column.

    ``type`` is a Spark SQL type name; ``formats`` lists date/time patterns
    tried in order; ``nullable=False`` makes a blank value a reject too.
    """

    name: str
    type: str
    formats: tuple[str, ...] = (ISO,)
    nullable: bool = True


def _entry(spec: ColumnSpec, raw: Column, typed: Column) -> Column:
    """A one-element array with the reject entry when the value is bad, else empty."""
    bad = ~is_blank(raw) & typed.isNull()
    if not spec.nullable:
        bad = bad | is_blank(raw)
    expected = spec.type if spec.nullable else f"{spec.type} not null"
    entry = F.struct(
        F.lit(spec.name).alias("column_name"),
        raw.cast("string").alias("raw_value"),
        F.lit(expected).alias("expected_type"),
    )
    return F.when(bad, F.array(entry)).otherwise(F.array().cast(f"array<{REJECT_ENTRY}>"))


def apply_types(df: DataFrame, specs: Sequence[ColumnSpec]) -> DataFrame:
    """Typed columns in place of their text, other columns unchanged, plus
    ``_rejects`` (array of entries) and ``_rejected`` (boolean).

    Two projections: the first parses every value once, the second compares
    typed and raw values. Catalyst keeps them apart (a parsed value is used
    twice, so collapsing would parse it twice) and both stay inside whole-stage
    codegen: the entries are joined with ``concat``, not a lambda, because
    higher-order functions are evaluated outside generated code.
    """
    by_name = {s.name: s for s in specs}
    missing = set(by_name) - set(df.columns)
    if missing:
        raise ValueError(f"specs name columns not in the frame: {sorted(missing)}")
    parsed = df.select(
        *[
            parse_as(F.col(c), by_name[c].type, by_name[c].formats).alias(c) if c in by_name else F.col(c)
            for c in df.columns
        ],
        *[F.col(c).alias(f"__raw_{c}") for c in df.columns if c in by_name],
    )
    entries = [_entry(by_name[c], F.col(f"__raw_{c}"), F.col(c)) for c in df.columns if c in by_name]
    if not entries:
        rejects = F.array().cast(f"array<{REJECT_ENTRY}>")
    elif len(entries) == 1:
        rejects = entries[0]
    else:
        rejects = F.concat(*entries)
    return parsed.select(*df.columns, rejects.alias(REJECTS)).withColumn(REJECTED, F.size(F.col(REJECTS)) > 0)


def repair_types(rejected: DataFrame, specs: Sequence[ColumnSpec]) -> DataFrame:
    """Rejected rows of :func:`apply_types` read again under other ``specs``, from the raw text that they keep.

    Only values that were bad are parsed; the others stay as they were typed.
    The types have to be those of before, so that the rows fit the accepted ones.
    """
    entries = []
    out = {c: F.col(c) for c in rejected.columns if c not in (REJECTS, REJECTED)}
    raw_of = {}
    for spec in specs:
        place = F.array_position(F.col(f"{REJECTS}.column_name"), spec.name)
        raw_of[spec.name] = F.when(place > 0, F.get(F.col(f"{REJECTS}.raw_value"), (place - 1).cast("int")))
        out[spec.name] = F.when(place > 0, parse_as(raw_of[spec.name], spec.type, spec.formats)).otherwise(F.col(spec.name))
    parsed = rejected.select(
        *[c.alias(n) for n, c in out.items()],
        *[raw_of[s.name].alias(f"__raw_{s.name}") for s in specs],
        F.col(f"{REJECTS}.column_name").alias("__bad"),
    )
    changed = [n for n in out if parsed.schema[n].dataType != rejected.schema[n].dataType]
    if changed:
        raise ValueError(f"a rule that changes types needs a full run: {changed}")
    none = F.array().cast(f"array<{REJECT_ENTRY}>")
    for spec in specs:
        again = _entry(spec, F.col(f"__raw_{spec.name}"), F.col(spec.name))
        entries.append(F.when(F.array_contains("__bad", spec.name), again).otherwise(none))
    return parsed.select(*out, F.concat(none, *entries).alias(REJECTS)).withColumn(REJECTED, F.size(REJECTS) > 0)


def accepted_rows(typed: DataFrame) -> DataFrame:
    return typed.filter(~F.col(REJECTED)).drop(REJECTS, REJECTED)


def reject_entries(typed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per bad value: the row's (typed) keys, column, raw text, expected type."""
    return (
        typed.filter(F.col(REJECTED))
        .select(*[F.col(k) for k in keys], F.explode(REJECTS).alias("_e"))
        .select(*keys, "_e.column_name", "_e.raw_value", "_e.expected_type")
    )


def split_typed(
    df: DataFrame, specs: Sequence[ColumnSpec], keys: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejects) as two lazy frames over one projection.

    Writing both re-reads the input; the typed layer instead writes the
    output of :func:`apply_types` once, partitioned by ``_rejected``, and
    reads each side back with partition pruning
    (see :func:`landfall.plans.layers.type_table`). Keys in the rejects are
    typed; a key that itself failed is NULL there and has its own entry.
    """
    typed = apply_types(df, specs)
    return accepted_rows(typed), reject_entries(typed, keys)

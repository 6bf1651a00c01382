"""Histories of dimensions: validity intervals, and facts joined as of their time.

A version of a key is valid from its time until the next version's
(``valid_from`` included, ``valid_to`` not; NULL: open). :func:`as_of` finds for
each fact the version valid at its time with one shuffle and one sort of both
sides: versions and facts lie together in the order of time, and each fact takes
the last version before it. A key with very many facts is cut into slices of
time, and a version goes to the slices its interval touches, so no task holds
the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landfall.operators.dedup import keep_latest

FROM, TO = "valid_from", "valid_to"


def _same(columns: Sequence[str], earlier: Window) -> Column:
    """Whether all ``columns`` equal those of the row before."""
    same = F.lit(True)
    for c in columns:
        same = same & F.col(f"`{c}`").eqNullSafe(F.lag(F.col(f"`{c}`")).over(earlier))
    return same


def validity(changes: DataFrame, keys: Sequence[str], time: str, attributes: Sequence[str]) -> DataFrame:
    """(keys, attributes, valid_from, valid_to) of a log of changes.

    Of several changes of a key at one time the last in the order of the
    attributes counts; a change that changes nothing opens no version. Rows
    without a whole key or a time have no place in a history.
    """
    keys, attributes = list(keys), list(attributes)
    rows = changes.select(*keys, F.col(time).alias(FROM), *attributes)
    rows = rows.dropna(subset=[*keys, FROM])
    rows = keep_latest(rows, [*keys, FROM], [f"-{c}" for c in attributes])
    by_time = Window.partitionBy(*keys).orderBy(FROM)
    first = F.lag(F.lit(1)).over(by_time).isNull()
    rows = rows.withColumn("_new", first | ~_same(attributes, by_time)).filter("_new").drop("_new")
    return rows.withColumn(TO, F.lead(FROM).over(by_time)).select(*keys, *attributes, FROM, TO)


def close_and_open(
    history: DataFrame, log: DataFrame, changes: DataFrame, keys: Sequence[str], time: str, attributes: Sequence[str]
) -> DataFrame:
    """``history`` after more ``changes``: versions they end are closed, new ones opened.

    ``log`` holds all changes so far, the new ones included. The versions of
    the keys that change are laid out anew from it, so a late change takes its
    place, also before one that had changed nothing until then; the versions
    of all other keys are passed on as they are.
    """
    keys, attributes = list(keys), list(attributes)
    touched = changes.dropna(subset=[*keys, time]).select(*keys).distinct()
    kept = history.join(touched, keys, "left_anti").select(*keys, *attributes, FROM, TO)
    return kept.unionByName(validity(log.join(touched, keys, "left_semi"), keys, time, attributes))


def hot_slices(facts: DataFrame, keys: Sequence[str], time: str, rows_per_slice: int) -> DataFrame:
    """(keys, cuts): times at which the keys with more than ``rows_per_slice`` facts are cut, about evenly.

    Counts and quantiles are partial aggregates; the result has at most
    facts / rows_per_slice rows.
    """
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    counted = facts.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > rows_per_slice)
    hot = facts.join(counted, list(keys), "left_semi") if keys else facts
    quarters = F.percentile_approx(micros, F.array(*[F.lit(i / 64) for i in range(1, 64)]), 10_000)
    cuts = hot.groupBy(*keys).agg(F.count("*").alias("_n"), quarters.alias("_q"))
    # Every so many of the 64 parts, that a slice holds about rows_per_slice facts.
    step = F.greatest(F.lit(1), F.floor(F.lit(64.0 * rows_per_slice) / F.col("_n"))).cast("int")
    chosen = F.filter("_q", lambda q, i: (i + 1) % step == 0)
    return cuts.select(*keys, F.array_sort(F.array_distinct(chosen)).alias("_cuts"))


def as_of(
    facts: DataFrame,
    history: DataFrame,
    keys: Sequence[str],
    time: str,
    attributes: Sequence[str],
    rows_per_slice: int = 1_000_000,
) -> DataFrame:
    """``facts`` with the ``attributes`` and ``valid_from`` of the version valid at ``time``; NULL where there is none.

    ``history`` has one version of a key at a time (:func:`validity`). Facts
    without a whole key or a time find none and are not shuffled.
    """
    keys, attributes = list(keys), list(attributes)
    clash = {*attributes, FROM} & set(facts.columns)
    if clash:
        raise ValueError(f"facts have columns named like the history's: {sorted(clash)}")
    spark_types = {f.name: f.dataType for f in history.schema.fields}
    found = [c for c in (*attributes, FROM)]
    row = F.struct(*[F.col(f"`{c}`").alias(c) for c in facts.columns])
    able = F.lit(True)
    for c in (*keys, time):
        able = able & F.col(f"`{c}`").isNotNull()
    slices = hot_slices(facts.filter(able), keys, time, rows_per_slice)
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    none = F.array().cast("array<bigint>")
    place = lambda t: F.size(F.filter("_cuts", lambda q: q <= t))

    def cut(df: DataFrame) -> DataFrame:
        return df.join(slices, keys, "left").withColumn("_cuts", F.coalesce("_cuts", none))

    moved = cut(facts.filter(able)).select(
        *[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)],
        place(micros(time)).alias("_slice"),
        F.col(time).alias("_time"),
        F.lit(1).alias("_fact"),
        row.alias("_row"),
        *[F.lit(None).cast(spark_types[c]).alias(f"_a_{c}") for c in found],
    )
    last = F.when(F.col(TO).isNull(), F.size("_cuts")).otherwise(place(micros(TO)))
    versions = (
        cut(history.dropna(subset=[*keys, FROM]))
        .withColumn("_slice", F.explode(F.sequence(place(micros(FROM)), last)))
        .select(
            *[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)],
            "_slice",
            F.col(FROM).alias("_time"),
            F.lit(0).alias("_fact"),
            F.lit(None).cast(moved.schema["_row"].dataType).alias("_row"),
            *[F.col(f"`{c}`").alias(f"_a_{c}") for c in found],
        )
    )
    ks = [f"_k{i}" for i in range(len(keys))]
    before = Window.partitionBy(*ks, "_slice").orderBy("_time", "_fact").rowsBetween(Window.unboundedPreceding, 0)
    version = F.struct(*[F.col(f"_a_{c}").alias(c) for c in found])
    joined = (
        moved.unionByName(versions)
        .withColumn("_version", F.last(F.when(F.col("_fact") == 0, version), ignorenulls=True).over(before))
        .filter("_fact = 1")
        .select(*[F.col(f"_row.`{c}`").alias(c) for c in facts.columns], *[F.col(f"_version.`{c}`").alias(c) for c in found])
    )
    lost = facts.filter(~able).select(
        *[F.col(f"`{c}`") for c in facts.columns], *[F.lit(None).cast(spark_types[c]).alias(c) for c in found]
    )
    return joined.unionByName(lost)

"""One record for one entity of several sources.

Records match by rules. A rule asks for equal values of its fields, compared
after normalisation (letters and digits only, lower case), and may allow one
field to differ by one edit (a character replaced, added or left out). An
entity is what matching records reach, and each of its fields survives from the
most trusted source that has a value.

No pair of a block is ever listed, and none is lost:

* records with equal fields become one profile first, so copies meet nobody;
* equal fields link every profile to the smallest one (a star);
* an edit is found by its place. Two texts that differ in character ``i`` alone
  are equal once it is left out, and all texts with that remainder and place
  differ from each other there alone: again a star, of no more members than
  there are characters. A text with one character more meets the text that
  equals its remainder, which has no more partners than places times
  characters. So a block is bounded by the alphabet, whatever the data hold.

A profile gets one key for each character of its edited field, so the work
grows with the square of that field's length: names, not documents.

Defined cases: a record that lacks a field of a rule (NULL, or nothing left
after normalisation) takes no part in that rule; one without any match is an
entity of its own. Ids tell records apart: a repeated row counts once, and an id
whose rows differ belongs to the smallest of the entities they fall in.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landfall.operators.components import components, written


@dataclass(frozen=True)
class MatchRule:
    """Records match whose ``equal`` fields agree and whose ``edited`` field differs by at most one edit."""

    equal: tuple[str, ...] = ()
    edited: str | None = None


def normalised(c: Column) -> Column:
    """Lower case, letters and digits only; NULL if nothing is left."""
    text = F.regexp_replace(F.lower(c.cast("string")), r"[^\p{L}\p{N}]+", "")
    return F.when(text != "", text)


def _stars(profiles: DataFrame, fields: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Links of profiles with equal ``fields`` to the smallest of them, and these with their fields."""
    whole = profiles.filter(reduce(lambda a, b: a & b, [F.col(f).isNotNull() for f in fields]))
    first = written(whole.groupBy(*fields).agg(F.min("node").alias("first")), "first")  # a hot value is a join Spark may split
    links = whole.join(first, list(fields)).select(F.col("node").alias("a"), F.col("first").alias("b"))
    return links.filter("a <> b"), first


def one_edit_links(spellings: DataFrame, equal: Sequence[str], edited: str, node: str) -> DataFrame:
    """Links (a, b) between texts one edit apart, enough to connect all such texts; a text occurs once in ``spellings``."""
    left_out = F.expr(f"transform(sequence(1, char_length({edited})), i -> "
                      f"concat(substring({edited}, 1, i - 1), substring({edited}, i + 1)))")  # fmt: skip
    keys = spellings.select(*equal, F.col(node).alias("a"), F.posexplode(left_out).alias("_place", "_rest"))
    keys = written(keys, "edits")
    same_place = Window.partitionBy(*equal, "_rest", "_place")
    replaced = keys.select("a", F.min("a").over(same_place).alias("b")).filter("a <> b")
    shorter = spellings.select(*equal, F.col(edited).alias("_rest"), F.col(node).alias("b"))
    added = keys.join(shorter, [*equal, "_rest"]).select("a", "b")
    return replaced.union(added)


def match_entities(records: DataFrame, id_col: str, rules: Sequence[MatchRule]) -> DataFrame:
    """``id_col``, ``entity_id`` (the smallest id among matching records) for every id of ``records``."""
    fields = list(dict.fromkeys(f for r in rules for f in (*r.equal, *([r.edited] if r.edited else []))))
    names = {f: f"f{i}" for i, f in enumerate(fields)}
    compared = written(
        records.select(F.col(f"`{id_col}`").alias("id"), *[normalised(F.col(f"`{f}`")).alias(n) for f, n in names.items()]),
        "compared",
    )
    cols = list(names.values())
    present = lambda fs: reduce(lambda a, b: a & b, [F.col(names[f]).isNotNull() for f in fs])
    matchable = reduce(lambda a, b: a | b, [present([*r.equal, *([r.edited] if r.edited else [])]) for r in rules])
    alone = compared.filter(~matchable)  # equal or not, no rule applies to them
    compared = compared.filter(matchable)
    profiles = written(compared.groupBy(*cols).agg(F.min("id").alias("node")), "profiles")
    links = []
    for rule in rules:
        equal = [names[f] for f in rule.equal]
        edited = [names[rule.edited]] if rule.edited else []
        star, first = _stars(profiles, equal + edited)
        links.append(star)
        if edited:
            links.append(one_edit_links(first, equal, edited[0], "first"))
    label = written(components(reduce(DataFrame.union, links)), "labels")
    known = profiles.join(label, "node", "left")
    named = written(known.select(*cols, F.coalesce("component", "node").alias("entity_id")), "named")
    same = reduce(lambda a, b: a & b, [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in cols])
    rows = compared.alias("l").join(named.alias("r"), same).select(F.col("l.id").alias(id_col), "r.entity_id")
    return rows.union(alone.select("id", "id")).groupBy(id_col).agg(F.min("entity_id").alias("entity_id"))


def surviving_records(
    records: DataFrame, entities: DataFrame, id_col: str, trust: str, fields: Sequence[str]
) -> DataFrame:
    """One row per entity: ``entity_id``, ``record_count`` and each field from the record of the lowest
    (``trust``, id) that has a value; NULL if none has."""
    rows = records.join(entities, id_col)
    best = [
        F.min(F.when(F.col(f).isNotNull(), F.struct(F.col(trust), F.col(id_col), F.col(f).alias("_v"))))["_v"].alias(f)
        for f in fields
    ]
    return rows.groupBy("entity_id").agg(F.countDistinct(id_col).alias("record_count"), *best)

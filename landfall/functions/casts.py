"""Text to typed values, as JVM-side column expressions.

Every parser returns NULL for text it cannot convert, never raises (ANSI mode
is on by default in Spark 4, so a plain ``cast`` would abort the job). Whether
a NULL is an error is decided in :mod:`landfall.operators.typed`: text that is
present, not blank, and parses to NULL is a reject.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The boolean words we accept (PostgreSQL's boolean input words,
# compared after trim and lower case).
TRUE_WORDS = ("true", "t", "yes", "y", "on", "1")
FALSE_WORDS = ("false", "f", "no", "n", "off", "0")

# Fixed value: "iso" names Spark's own ISO-8601 reading of date or date-time text.
ISO = "iso"

_INTEGER_TEXT = r"^[+-]?[0-9]+$"
# A full date, perhaps with a time; no bare years and no zone offsets, which a wall clock can't hold.
_ISO_TEXT = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}([ T][0-9]{1,2}:[0-9]{1,2}(:[0-9]{1,2}([.][0-9]*)?)?)?$"
_TIME_LETTERS = set("HhkKmsSaAnN")
_NUMERIC_RUN = re.compile(r"(y+|M{1,2}|d+|H+|h+|m+|s+)$")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c: Column | str) -> Column:
    """NULL, empty or only whitespace: a missing value, not an error."""
    c = _col(c)
    return c.isNull() | (F.trim(c) == F.lit(""))


def parse_int(c: Column | str, type_name: str = "int") -> Column:
    """Whole numbers only: ``' 2 '`` and ``'+5'`` parse, ``'3.7'`` and ``'1e3'`` do not."""
    text = F.trim(_col(c))
    return F.when(text.rlike(_INTEGER_TEXT), text.try_cast(type_name))


def parse_decimal(c: Column | str, precision: int, scale: int) -> Column:
    """Rounded half-up to ``scale``; text out of range or with separators is NULL."""
    return F.trim(_col(c)).try_cast(f"decimal({precision},{scale})")


def parse_double(c: Column | str) -> Column:
    return F.trim(_col(c)).try_cast("double")


def parse_boolean(c: Column | str) -> Column:
    word = F.lower(F.trim(_col(c)))
    return (
        F.when(word.isin(*TRUE_WORDS), F.lit(True))
        .when(word.isin(*FALSE_WORDS), F.lit(False))
        .otherwise(F.lit(None).cast("boolean"))
    )


def _has_time(pattern: str) -> bool:
    # Letters inside quotes are literals in a datetime pattern.
    outside = pattern.split("'")[::2]
    return any(ch in _TIME_LETTERS for part in outside for ch in part)


def _shape(pattern: str) -> str | None:
    """A regular expression for how text must begin to fit a datetime pattern; None if any text may.

    Spark's parser raises and catches an exception for every text that does not
    fit, which costs far more than the look at its digits and separators.
    """
    if set(pattern) & set("'[]{}#p"):
        return None
    shape = ""
    for run in re.findall(r"([A-Za-z])(\1*)|(.)", pattern, re.DOTALL):
        letters, other = run[0] + run[1], run[2]
        if other:
            shape += re.escape(other)
        else:
            shape += r"\s*[+-]?[0-9]+" if _NUMERIC_RUN.match(letters) else "(?s:.*?)"
    return r"^\s*" + shape


def _in_shape(text: Column, pattern: str, parsed: Column) -> Column:
    shape = _shape(pattern)
    return parsed if shape is None else F.when(text.rlike(shape), parsed)


def parse_timestamp(c: Column | str, formats: Sequence[str] = (ISO,)) -> Column:
    """First format that parses wins; result is ``timestamp_ntz`` (wall clock).

    ``iso`` is parsed without any time zone. A date-only pattern is read as a
    date (also zone-free); a pattern with time fields is read in the session
    zone and converted back to a wall clock, exact for every existing local time.
    """
    text = F.trim(_col(c))
    parsed = []
    for fmt in formats:
        if fmt == ISO:
            parsed.append(F.when(text.rlike(_ISO_TEXT), text.try_cast("timestamp_ntz")))
        elif _has_time(fmt):
            parsed.append(_in_shape(text, fmt, F.try_to_timestamp(text, F.lit(fmt)).cast("timestamp_ntz")))
        else:
            parsed.append(_in_shape(text, fmt, F.try_to_date(text, fmt).cast("timestamp_ntz")))
    return parsed[0] if len(parsed) == 1 else F.coalesce(*parsed)


def parse_date(c: Column | str, formats: Sequence[str] = (ISO,)) -> Column:
    text = F.trim(_col(c))
    parsed = []
    for fmt in formats:
        if fmt == ISO:
            parsed.append(F.when(text.rlike(_ISO_TEXT), text.try_cast("date")))
        else:
            parsed.append(_in_shape(text, fmt, F.try_to_date(text, fmt)))
    return parsed[0] if len(parsed) == 1 else F.coalesce(*parsed)


def parse_as(c: Column | str, type_name: str, formats: Sequence[str] = (ISO,)) -> Column:
    """Dispatch on a Spark SQL type name (``int``, ``decimal(12,2)``, ``timestamp`` …)."""
    t = type_name.strip().lower()
    if t in ("int", "integer", "bigint", "long", "smallint", "tinyint"):
        return parse_int(c, "bigint" if t in ("bigint", "long") else t)
    if t.startswith("decimal"):
        inner = t[t.index("(") + 1 : t.index(")")] if "(" in t else "10,0"
        p, s = (int(x) for x in (inner if "," in inner else f"{inner},0").split(","))
        return parse_decimal(c, p, s)
    if t in ("double", "float"):
        return parse_double(c).cast(t)
    if t in ("boolean", "bool"):
        return parse_boolean(c)
    if t in ("timestamp", "timestamp_ntz"):
        return parse_timestamp(c, formats)
    if t == "date":
        return parse_date(c, formats)
    if t in ("string", "varchar", "text"):
        return _col(c).cast("string")
    raise ValueError(f"unsupported target type {type_name!r}")

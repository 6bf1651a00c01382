from landfall.functions.casts import (
    FALSE_WORDS,
    ISO,
    TRUE_WORDS,
    is_blank,
    parse_as,
    parse_boolean,
    parse_date,
    parse_decimal,
    parse_double,
    parse_int,
    parse_timestamp,
)

__all__ = [
    "FALSE_WORDS",
    "ISO",
    "TRUE_WORDS",
    "is_blank",
    "parse_as",
    "parse_boolean",
    "parse_date",
    "parse_decimal",
    "parse_double",
    "parse_int",
    "parse_timestamp",
]

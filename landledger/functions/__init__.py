from landledger.functions.keys import PrefixRule, map_key
from landledger.functions.labels import publication_label, quarter_label
from landledger.functions.parsing import (
    blank_to_null,
    decimal_comma,
    finite,
    parse_date,
    parse_double,
    parse_int,
    round_score,
)

__all__ = [
    "PrefixRule",
    "blank_to_null",
    "decimal_comma",
    "finite",
    "map_key",
    "parse_date",
    "parse_double",
    "parse_int",
    "publication_label",
    "quarter_label",
    "round_score",
]

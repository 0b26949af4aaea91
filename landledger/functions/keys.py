"""Mapping of detailed keys to the parent key that a lookup uses."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from landledger.functions.parsing import as_column


class PrefixRule(NamedTuple):
    prefix: str
    parent: str


def map_key(
    col: Column | str,
    prefix_rules: Sequence[PrefixRule | tuple[str, str]] = (),
    exact: Mapping[str, str] | None = None,
) -> Column:
    """Parent of a key: first matching prefix rule, then exact match, else itself.

    Rules are data. They compile to one literal-map lookup and a short chain of
    prefix tests; for mappings of thousands of keys use
    :func:`landledger.operators.lookup.remap_keys`, which joins instead.
    """
    c = as_column(col)
    candidates = [F.when(c.startswith(prefix), F.lit(parent)) for prefix, parent in prefix_rules]
    if exact:
        pairs = [F.lit(item) for pair in exact.items() for item in pair]
        candidates.append(F.try_element_at(F.create_map(*pairs), c))
    return F.coalesce(*candidates, c)

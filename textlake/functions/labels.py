"""Label mappings."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Class names and their codes.
RELIABLE_TYPES = ["reliable", "political"]
RELIABLE_STATEMENTS = ["true", "mostly-true", "half-true"]
STATEMENT_CODES = {
    "pants-fire": 1, "false": 1, "barely-true": 1,
    "half-true": 0, "mostly-true": 0, "true": 0,
}
LABEL_NAMES = {0: "reliable", 1: "fake"}


def _zero_if_member(label: Column, members: list[str]) -> Column:
    return F.when(F.coalesce(label.isin(*members), F.lit(False)), 0).otherwise(1)


def binarise(label: Column) -> Column:
    """0 for the reliable article types, 1 for every other type."""
    return _zero_if_member(label, RELIABLE_TYPES)


def statement_label(label: Column) -> Column:
    """0 for the reliable statement labels, 1 for all others, unknown and null included."""
    return _zero_if_member(label, RELIABLE_STATEMENTS)


def statement_label_or_null(label: Column) -> Column:
    """Dictionary mapping of the six statement labels; null where there is no entry."""
    codes = F.create_map(*[F.lit(x) for x in chain.from_iterable(STATEMENT_CODES.items())])
    return F.try_element_at(codes, label)

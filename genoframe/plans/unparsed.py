"""Variants as they come from a reader, with their genotype rows before parsing.

A column of genotype arrays is parsed whole, in lambdas that Spark interprets, even
where a query reads one member of them. Rows that are exploded first are parsed in
compiled code, as far as they are read. So a reader leaves word how to make such rows,
and operators that explode the variants of a reader begin with them.
"""

from __future__ import annotations

from collections.abc import Callable
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame

_ROWS: WeakKeyDictionary[DataFrame, Callable[[], DataFrame]] = WeakKeyDictionary()


def with_rows(variants: DataFrame, rows: Callable[[], DataFrame]) -> DataFrame:
    """The variants, which ``rows`` would return exploded: other columns, then ``genotype``."""
    _ROWS[variants] = rows
    return variants


def rows_of(variants: DataFrame) -> DataFrame | None:
    """The genotype rows of these very variants, None if they are not known."""
    rows = _ROWS.get(variants)
    return None if rows is None else rows()


def has_rows(variants: DataFrame) -> bool:
    return variants in _ROWS

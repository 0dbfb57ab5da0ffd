"""Helpers for writing column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value computed once. An expression used inside a lambda is computed for every
    element, and the optimizer may move a dear one there; a lambda variable is not."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def settled(value: Column) -> Column:
    """``value`` as a column that no optimizer rule moves into the expressions that use it: a Python function takes no
    argument whose lambdas are renamed on the way, as those of sorting are."""
    return F.when(F.monotonically_increasing_id() >= 0, value)


def positions(array: Column) -> Column:
    """0 to size-1; empty for an empty array."""
    return F.when(F.size(array) > 0, F.sequence(F.lit(0), F.size(array) - 1)).otherwise(
        F.array().cast("array<int>")
    )


def no_strings() -> Column:
    return F.array().cast("array<string>")

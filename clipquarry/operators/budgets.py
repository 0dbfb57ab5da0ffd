"""Budgets: running totals of an amount in the order of a score, and cuts by them.

A cut keeps a prefix of the order, so it is known by its last score (or last score and tie-break):
one pass finds that, and the rows are then picked by a plain comparison, which can reach the scan.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from clipquarry.operators.exact import adder
from clipquarry.operators.prefix import (
    Coarse,
    broadcast_if_small,
    coarse_budget,
    first_overflow,
    null_safe_join,
    running_total,
    score_totals,
)
from clipquarry.session import require_batch


Where = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Budget:
    """Running totals by score, and the lowest score that is within the limit."""

    totals: DataFrame
    score: str
    parts: tuple[str, ...]
    where: Where
    lowest: object
    unbounded: bool

    def attach(self, df: DataFrame) -> DataFrame:
        """Rows within the budget with their running total. The score is compared with a constant
        before anything else is tested."""
        if self.unbounded:
            pruned = df
        elif self.lowest is None:
            pruned = df.filter(F.lit(False))
        else:
            pruned = df.filter(F.col(self.score) >= F.lit(self.lowest))
        totals = broadcast_if_small(self.totals)
        return null_safe_join(self.where(pruned), totals, [*self.parts, self.score])


def find_budget(
    df: DataFrame,
    score: str,
    amount: str,
    out: str = "running_total",
    parts: Sequence[str] = (),
    limit: int | float | None = None,
    where: Where = lambda rows: rows,
    one_task_rows: int | None = None,
) -> Budget:
    """The running totals by score of the rows that pass ``where``. With a limit, one pass over all
    rows finds a score below which none can be kept, and the exact totals are made above it; where
    each of its bins held one score, as with small counts, they are exact already."""
    require_batch(df, "find_budget")
    coarse, add = Coarse(None, None), adder(where(df), F.col(amount))
    if limit is not None:
        coarse = coarse_budget(where(df), score, F.col(amount), out, limit, parts, add)
    totals = coarse.totals
    if totals is None:
        above = df if coarse.floor is None else df.filter(F.col(score) >= F.lit(coarse.floor))
        totals = running_total(
            score_totals(where(above), score, F.col(amount), parts, add),
            [F.col(score).desc_nulls_last()],
            add,
            out,
            parts,
            one_task_rows,
        )
    if limit is not None:
        totals = totals.filter(F.col(out) <= limit)
    kept = totals.agg(
        F.min(score).alias("lowest"),
        F.coalesce(F.bool_or(F.col(score).isNull()), F.lit(False)).alias("nulls"),
    ).first()
    return Budget(
        totals.select(*parts, score, out),
        score,
        tuple(parts),
        where,
        kept["lowest"],
        # Null scores come last: where they are kept, every score is.
        limit is None or kept["nulls"],
    )


def running_budget(
    df: DataFrame,
    score: str,
    amount: str,
    out: str = "running_total",
    parts: Sequence[str] = (),
    limit: int | float | None = None,
    one_task_rows: int | None = None,
) -> DataFrame:
    """``SUM(amount) OVER (PARTITION BY parts ORDER BY score DESC)`` with its RANGE frame: rows with
    one score share one total, so they enter or leave a budget together. With ``limit`` only rows
    whose total is within it are kept. Null scores come last."""
    return find_budget(
        df, score, amount, out, parts, limit, one_task_rows=one_task_rows
    ).attach(df)


def partitioned_budget(
    df: DataFrame,
    bucket: str,
    score: str,
    amount: str,
    cap: int | float = 100_000,
    out: str = "partition_running_total",
) -> DataFrame:
    """The same running total within each bucket, cut at ``cap``: a pre-prune that loses no row of a
    later whole-table budget up to ``cap``."""
    return running_budget(df, score, amount, out, [bucket], cap)


def take_within_budget(
    df: DataFrame,
    score: str,
    amount: str,
    limit: int | float,
    tie_break: Sequence[str],
    one_task_rows: int | None = None,
) -> DataFrame:
    """Rows in order of score (descending), then ``tie_break`` (ascending), up to the first one that
    would take the summed amount over ``limit``. Amounts must not be negative; null counts as 0.
    ``tie_break`` should identify a row; rows alike in it are taken together or not at all."""
    require_batch(df, "take_within_budget")
    spent = F.coalesce(F.col(amount), F.lit(0))
    checked = F.when(
        spent < 0, F.raise_error(F.lit(f"take_within_budget: negative {amount}"))
    ).otherwise(spent)

    add = adder(df, spent)
    edge = first_overflow(df, [score], checked, limit, True, one_task_rows, add)
    if edge is None:  # everything fits
        return df
    # Whole groups above the edge fit; the edge group is filled up in tie-break order.
    value = edge.keys[0]
    at_edge = F.col(score).eqNullSafe(F.lit(value))
    tie = first_overflow(df.filter(at_edge), tie_break, checked, limit, False, one_task_rows, add, edge.before)
    above = F.col(score).isNotNull() if value is None else F.col(score) > F.lit(value)
    within = at_edge if tie is None else at_edge & _before(df, tie_break, tie.keys)
    # The first test is implied by the second, but alone it can reach the scan.
    reach = F.lit(True) if value is None else F.col(score) >= F.lit(value)
    return df.filter(reach & (above | within))


def _before(df: DataFrame, columns: Sequence[str], edge: Row) -> Column:
    """Rows before ``edge`` in ascending order with nulls first."""
    if len(columns) > 1:  # structs compare field by field, nulls first
        types = {f.name: f.dataType for f in df.select(*columns).schema.fields}
        bound = F.struct(*[F.lit(v).cast(types[c]).alias(c) for c, v in zip(columns, edge)])
        return F.struct(*columns) < bound
    column = F.col(columns[0])
    return F.lit(False) if edge[0] is None else column.isNull() | (column < F.lit(edge[0]))

"""First or latest row per key, row numbers, samples and orders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipquarry.operators.prefix import broadcast_if_small, null_safe_join
from clipquarry.session import freeze, require_batch

PLACE_BITS = 33  # of monotonically_increasing_id: below them the partition's number


def _as_columns(order_by: Sequence[Column | str] | Column | str) -> list[Column]:
    listed = [order_by] if isinstance(order_by, (str, Column)) else order_by
    return [F.col(o) if isinstance(o, str) else o for o in listed]


def keep_latest(
    df: DataFrame, key: str, order_by: Sequence[Column | str] | Column | str, out: str = "rn"
) -> DataFrame:
    """The first row of each key in ``order_by`` (give a descending column first, then a tie-break),
    with its row number, always 1. The rank test prunes every task to one row per key before the
    shuffle, so a key with very many rows costs no more than others."""
    require_batch(df, "keep_latest")
    window = Window.partitionBy(key).orderBy(*_as_columns(order_by))
    return df.withColumn(out, F.row_number().over(window)).filter(F.col(out) == 1)


def first_labelled_per_id(
    df: DataFrame, key: str, label: str, order_by: Sequence[Column | str] | Column | str
) -> DataFrame:
    """The first row per id that has a label. Rows without one do not claim the id."""
    labelled = df.filter(F.col(label).isNotNull() & (F.col(label) != ""))
    return keep_latest(labelled, key, order_by, "_rn").drop("_rn")


def sample_head(
    df: DataFrame, n: int | None, order_by: Sequence[Column | str] | Column | str
) -> DataFrame:
    """The first ``n`` rows in an explicit order; all rows for ``None``."""
    return df if n is None else df.orderBy(*_as_columns(order_by)).limit(n)


def order_by_score(df: DataFrame, score: str, tie_break: Sequence[str]) -> DataFrame:
    """Highest score first, nulls last, ties in the order of ``tie_break``."""
    return df.orderBy(F.col(score).desc_nulls_last(), *tie_break)


def number_rows(
    df: DataFrame,
    order_by: Sequence[str],
    ascending: bool | Sequence[bool] = True,
    out: str = "Index",
    within: Sequence[str] = (),
) -> DataFrame:
    """Row number from 0 in the order of the columns ``order_by``, which should decide it; counted
    anew for each value of ``within``. Pass a table that is cheap to read, with only the columns that
    are needed later: it is read twice, once to find the ranges.

    The rows are shuffled once: range-partitioned, sorted and stored with their place in the partition. A
    row's number is that place on from the number of rows in the partitions before it, which are
    one row per partition and value of ``within``."""
    require_batch(df, "number_rows")
    up = [ascending] * len(order_by) if isinstance(ascending, bool) else ascending
    order = [F.col(o).asc() if a else F.col(o).desc() for o, a in zip(order_by, up)]
    keys = [F.col(w).asc() for w in within]
    ranged = freeze(
        df.repartitionByRange(*keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("_at", F.monotonically_increasing_id())
    ).withColumn("_range", F.shiftright("_at", PLACE_BITS))
    earlier = Window.partitionBy(*within).orderBy("_range")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy(*within, "_range").agg(
        F.count(F.lit(1)).alias("_start"), F.min("_at").alias("_first")
    )
    starts = starts.withColumn("_start", F.coalesce(F.sum("_start").over(earlier), F.lit(0)))
    return (
        null_safe_join(ranged, broadcast_if_small(starts), [*within, "_range"])
        .withColumn(out, (F.col("_start") + F.col("_at") - F.col("_first")).cast("long"))
        .drop("_range", "_start", "_at", "_first")
    )

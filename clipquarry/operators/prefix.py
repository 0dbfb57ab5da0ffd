"""Running totals over a whole table, and exact quantiles, without a one-task window.

A running total that depends only on a score needs one number per *distinct* score. So the table is
first reduced to score totals (combined map-side; a score held by a third of all rows becomes one
row), which are stored, and only those few rows are put in order. When there are too many of them
for one task they are range-partitioned and the partitions' own running totals are shifted by the
totals of the partitions before them.

Where only the top of the order or a few ranks are wanted, a coarse histogram comes first: it says
which narrow range of scores can matter, and only rows in that range get exact totals.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipquarry.operators.exact import ROWS, Adder, adder
from clipquarry.session import freeze, require_batch

ONE_TASK_ROWS = 1_000_000  # of ~40 bytes each: what one ordering task may be given
BROADCAST_ROWS = 200_000  # what a broadcast may hold
BROADCAST_BYTES = 64 << 20

_FIRST, _BEFORE = Window.unboundedPreceding, Window.currentRow


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on equally named columns in which null matches null."""
    renamed = right.select(
        *[F.col(k).alias(f"_right_{k}") for k in keys],
        *[c for c in right.columns if c not in keys],
    )
    on = [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    return left.join(renamed, on, how).drop(*[f"_right_{k}" for k in keys])


def fits_broadcast(stored: DataFrame) -> bool:
    """Whether a stored, narrow table was counted and measured to be small enough to broadcast."""
    lengths = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in stored.columns]
    size = stored.agg(
        F.count(F.lit(1)).alias("rows"), F.sum(reduce(lambda a, b: a + b, lengths)).alias("bytes")
    ).first()
    return size["rows"] <= BROADCAST_ROWS and (size["bytes"] or 0) <= BROADCAST_BYTES


def broadcast_if_small(stored: DataFrame) -> DataFrame:
    return F.broadcast(stored) if fits_broadcast(stored) else stored


def score_totals(
    df: DataFrame, score: str | Sequence[str], amount: Column, parts: Sequence[str] = (), add: Adder | None = None
) -> DataFrame:
    """One stored row per distinct (parts, score): the sums of the amount (null without any) and the
    ``_rows``."""
    require_batch(df, "score_totals")
    add = adder(df, amount) if add is None else add
    scores = [score] if isinstance(score, str) else list(score)
    return freeze(df.groupBy(*parts, *scores).agg(*add.sums(amount), F.count(F.lit(1)).alias("_rows")))


def running_total(
    totals: DataFrame,
    order: Sequence[Column],
    add: Adder,
    out: str,
    parts: Sequence[str] = (),
    one_task_rows: int | None = None,
    start: Sequence[int] = (),
) -> DataFrame:
    """Running total over the rows of a stored table in ``order``, within ``parts``, on from the sums
    ``start``: null before the first amount that is not. The sums behind it are in ``_run`` columns."""
    one_task_rows = ONE_TASK_ROWS if one_task_rows is None else one_task_rows
    if totals.count() <= one_task_rows:
        run = add.run(totals, Window.partitionBy(*parts).orderBy(*order).rowsBetween(_FIRST, _BEFORE))
        return _finished(run, add, out, start)

    # The partition number must not change between the two uses, so it is stored with the rows.
    ranged = freeze(
        totals.repartitionByRange(*[F.col(p) for p in parts], *order).withColumn(
            "_range", F.spark_partition_id()
        )
    )
    inside = Window.partitionBy(*parts, "_range").orderBy(*order).rowsBetween(_FIRST, _BEFORE)
    # One row per (parts, range): as many as there are shuffle partitions, plus one per part.
    earlier = Window.partitionBy(*parts).orderBy("_range").rowsBetween(_FIRST, -1)
    shifts = ranged.groupBy(*parts, "_range").agg(*[F.sum(n).alias(n) for n in add.names])
    shifts = add.run(shifts, earlier, "_shift").drop(*add.names)
    run = null_safe_join(add.run(ranged, inside), broadcast_if_small(shifts), [*parts, "_range"])
    both = {
        f"_run{n}": F.coalesce(F.col(f"_run{n}") + F.col(f"_shift{n}"), F.col(f"_run{n}"), F.col(f"_shift{n}"))
        for n in add.names
    }
    run = run.withColumns(both).drop("_range", *[f"_shift{n}" for n in add.names])
    return _finished(run, add, out, start)


def _finished(run: DataFrame, add: Adder, out: str, start: Sequence[int] = ()) -> DataFrame:
    if any(start):
        run = run.withColumns({f"_run{n}": F.col(f"_run{n}") + F.lit(s) for n, s in zip(add.names, start)})
    return run.withColumn(out, add.value(add.columns()))


def is_numeric(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.NumericType)


def _bin(score: str) -> Column:
    """A whole number that grows with the score: 64 bins to each power of two, mirrored for negative
    scores. No more than some 280,000 values whatever the scores are; null for null."""
    x = F.col(score).cast("double")
    size = F.abs(x)
    endless = F.lit(1 << 17)
    step = F.when(size < F.lit(float("inf")), F.floor(F.log2(size) * 64) + 1100 * 64)
    step = step.otherwise(endless)
    return (
        F.when(F.isnan(x), endless + 1).when(x > 0, step).when(x < 0, -step).when(x == 0, F.lit(0))
    )


def coarse_totals(
    df: DataFrame, score: str, amount: Column, parts: Sequence[str] = (), add: Adder | None = None
) -> DataFrame:
    """One stored row per (parts, bin of scores): what is needed to know where an exact total lies."""
    require_batch(df, "coarse_totals")
    add = adder(df, amount) if add is None else add
    value = F.col(score).cast("double")
    return freeze(
        df.groupBy(*parts, _bin(score).alias("_bin")).agg(
            *add.sums(amount, empty=True),
            F.min(amount).alias("_least"),
            F.count(amount).alias("_known"),
            F.count(F.lit(1)).alias("_all"),
            F.min(score).alias("_low"),
            F.max(score).alias("_high"),
            F.avg(value).alias("_mean"),
            F.var_pop(value).alias("_var"),
        )
    )


class Coarse(NamedTuple):
    """What a coarse histogram says about a limit: a score below which every row is over it for sure
    (None where there is none), and the exact totals where each bin held just one score."""

    floor: object | None
    totals: DataFrame | None


def coarse_budget(
    df: DataFrame,
    score: str,
    amount: Column,
    out: str,
    limit: int | float,
    parts: Sequence[str] = (),
    add: Adder | None = None,
) -> Coarse:
    """One pass over ``df`` to narrow a budget down. Amounts below zero make totals fall again, so
    they rule a floor out."""
    if not is_numeric(df, score):
        return Coarse(None, None)
    add = adder(df, amount) if add is None else add
    down = Window.partitionBy(*parts).orderBy(F.col("_bin").desc_nulls_last())
    so_far = down.rowsBetween(_FIRST, _BEFORE)
    totals = add.run(coarse_totals(df, score, amount, parts, add), so_far)
    totals = totals.withColumns(
        {
            out: add.value(add.columns()),
            "_earlier": add.value([r - F.col(n) for r, n in zip(add.columns(), add.names)]),
            "_known": F.sum("_known").over(so_far),
        }
    )
    within = F.col("_earlier") <= limit
    one_score = F.col("_low").eqNullSafe(F.col("_high"))
    found = totals.agg(
        F.min(F.when(within, F.col("_low"))).alias("lowest"),
        F.bool_or(within & F.col("_bin").isNull()).alias("nulls"),
        F.bool_and(F.when(within, one_score)).alias("exact"),
        F.min("_least").alias("least"),
    ).first()
    if (found["least"] or 0) < 0:
        return Coarse(None, None)
    running = F.when(F.col("_known") > 0, F.col(out)).alias(out)
    exact = totals.filter(within).select(*parts, F.col("_low").alias(score), running)
    return Coarse(
        None if found["nulls"] else found["lowest"], exact if found["exact"] else None
    )


class Edge(NamedTuple):
    """A group of equal keys, and the sums of the amounts before it."""

    keys: Row
    before: tuple[int, ...]


def first_overflow(
    df: DataFrame,
    keys: Sequence[str],
    amount: Column,
    limit: int | float,
    down: bool,
    one_task_rows: int | None = None,
    add: Adder | None = None,
    start: Sequence[int] = (),
) -> Edge | None:
    """The first group of equal ``keys``, in descending order with nulls last or ascending with nulls
    first, whose running total, on from the sums ``start``, is over ``limit``. None when all amounts,
    which must not be negative, fit. For one numeric key only the bin that holds the overflow gets
    exact totals."""
    add = adder(df, amount) if add is None else add
    if len(keys) == 1 and is_numeric(df, keys[0]):
        order = F.col("_bin").desc_nulls_last() if down else F.col("_bin").asc_nulls_first()
        window = Window.orderBy(order).rowsBetween(_FIRST, _BEFORE)  # a bounded number of bins
        totals = add.run(coarse_totals(df, keys[0], amount, (), add), window)
        totals = _finished(totals, add, "_total", start)
        found = totals.filter(F.col("_total") > limit).orderBy(order).first()
        if found is None:
            return None
        start, low, high = _sums_before(found, add), found["_low"], found["_high"]
        if low == high:
            return Edge(Row(low), start)
        df = df.filter(F.col(keys[0]).between(F.lit(low), F.lit(high)))

    order = [F.col(k).desc_nulls_last() if down else F.col(k).asc_nulls_first() for k in keys]
    totals = score_totals(df, keys, amount, (), add)
    totals = running_total(totals, order, add, "_total", (), one_task_rows, start)
    found = totals.filter(F.col("_total") > limit).orderBy(*order).first()
    return None if found is None else Edge(Row(*[found[k] for k in keys]), _sums_before(found, add))


def _sums_before(row: Row, add: Adder) -> tuple[int, ...]:
    return tuple(row[f"_run{n}"] - row[n] for n in add.names)


def quantile_row(
    df: DataFrame,
    value: str,
    probabilities: Sequence[float],
    interpolate: bool = True,
    one_task_rows: int | None = None,
) -> Row:
    """Exact statistics of a numeric column as one row: ``n``, ``mean``, ``var_pop`` and ``q0``,
    ``q1``, … (linear interpolation between neighbours, or the lower neighbour's rank rule of
    ``percentile_disc``).

    One pass makes a coarse histogram, with each bin's mean and variance. A second pass counts the
    distinct values of just the bins that hold a wanted rank. Only finished rows reach the driver."""
    coarse = coarse_totals(df.filter(F.col(value).isNotNull()), value, F.lit(1), (), ROWS)
    up = Window.orderBy("_bin").rowsBetween(_FIRST, _BEFORE)  # a bounded number of bins
    coarse = coarse.withColumn("_last", F.sum("_rows").over(up))
    weighted = F.sum(F.col("_mean") * F.col("_rows"))
    whole = coarse.agg(F.sum("_rows").alias("n"), weighted.alias("s")).first()
    n = whole["n"] or 0
    mean = whole["s"] / n if n else None

    places = [_ranks(p, n, interpolate) for p in probabilities]
    wanted = sorted({rank for low, high, _ in places for rank in (low, high)})
    first = F.col("_last") - F.col("_rows")
    here = [F.when((first < r) & (F.col("_last") >= r), first).alias(f"b{r}") for r in wanted]
    gap = F.col("_mean") - F.lit(mean).cast("double")
    spread = F.sum(F.col("_rows") * (F.col("_var") + gap * gap)) / F.lit(n or None).cast("double")
    found = coarse.agg(
        spread.alias("var_pop"),
        *[F.max(h).alias(f"before{r}") for h, r in zip(here, wanted)],
        *[F.max(F.when(h.isNotNull(), F.col("_low"))).alias(f"low{r}") for h, r in zip(here, wanted)],
        *[F.max(F.when(h.isNotNull(), F.col("_high"))).alias(f"high{r}") for h, r in zip(here, wanted)],
    ).first()

    values = {r: found[f"low{r}"] for r in wanted}
    open_ranks = [r for r in wanted if found[f"low{r}"] != found[f"high{r}"]]
    if open_ranks:
        ranges = {(found[f"low{r}"], found[f"high{r}"]) for r in open_ranks}
        inside = reduce(
            lambda a, b: a | b, [F.col(value).between(F.lit(x), F.lit(y)) for x, y in ranges]
        )
        totals = df.filter(inside).groupBy(value).agg(*ROWS.sums(F.lit(1)))
        ranked = running_total(freeze(totals), [F.col(value).asc()], ROWS, "_rank", (), one_task_rows)
        # Rows of wanted bins further down stand before a bin in this ranking too.
        lower = {r: F.when(F.col(value) < F.lit(found[f"low{r}"]), F.col("_rank")) for r in open_ranks}
        shifts = ranked.agg(
            *[F.coalesce(F.max(c), F.lit(0)).alias(f"k{r}") for r, c in lower.items()]
        ).first()
        exact = ranked.agg(
            *[
                F.min(
                    F.when(F.col("_rank") >= r - found[f"before{r}"] + shifts[f"k{r}"], F.col(value))
                ).alias(f"v{r}")
                for r in open_ranks
            ]
        ).first()
        values.update({r: exact[f"v{r}"] for r in open_ranks})

    quantiles = {}
    for i, (low, high, part) in enumerate(places):
        a, b = values[low], values[high]
        quantiles[f"q{i}"] = a if a is None or not interpolate else float(a) + (float(b) - float(a)) * part
    return Row(n=n, mean=mean, var_pop=found["var_pop"], **quantiles)


def _ranks(p: float, n: int, interpolate: bool) -> tuple[int, int, float]:
    """The two ranks (from 1) around a quantile, and the share of the way between them."""
    if not interpolate:
        rank = max(1, math.ceil(round(p * n, 9)))
        return rank, rank, 0.0
    place = p * max(n - 1, 0)
    return math.floor(place) + 1, math.ceil(place) + 1, place - math.floor(place)

"""Quantile sketches that are stored per part of a table and merged later, without the rows.

A KLL sketch of a column is a small binary value. Sketches of days, categories or files are kept as a table; any union of
them answers for all of their rows. Beside each are the counts and sums that give exact means and variances. Merging is a grouped aggregate,
so it combines map-side, and a new day costs only its own rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

K = 800  # size of a sketch, which sets its rank error
RANK_ERROR = 0.01  # of quantiles, at this size: what 99 in 100 sketches stay well below, merged or not


def sketch_parts(df: DataFrame, values: Sequence[str], by: Sequence[str], k: int = K) -> DataFrame:
    """One row per value of ``by``: for every column of ``values`` its ``<c>_sketch``, ``<c>_n``, ``<c>_sum`` and ``<c>_squares`` (sum of
    squares) over the rows where it is not null."""
    made = []
    for c in values:
        x = F.col(c).cast("double")
        made += [
            F.kll_sketch_agg_double(x, F.lit(k)).alias(f"{c}_sketch"),
            F.count(x).alias(f"{c}_n"),
            F.sum(x).alias(f"{c}_sum"),
            F.sum(x * x).alias(f"{c}_squares"),
        ]
    return df.groupBy(*by).agg(*made)


def merge_parts(parts: DataFrame, values: Sequence[str], by: Sequence[str] = (), k: int = K) -> DataFrame:
    """The same columns for the coarser groups ``by`` of stored parts; for all of them without ``by``."""
    made = []
    for c in values:
        made.append(F.kll_merge_agg_double(f"{c}_sketch", F.lit(k)).alias(f"{c}_sketch"))
        made += [F.sum(f"{c}_{s}").alias(f"{c}_{s}") for s in ("n", "sum", "squares")]
    return parts.groupBy(*by).agg(*made)


def sketch_statistics(parts: DataFrame, values: Sequence[str], percents: Sequence[float] = (0.5, 0.9, 0.99)) -> DataFrame:
    """Parts with ``mean_<c>``, ``variance_<c>``, ``stddev_<c>`` (of a sample) and ``P50_<c>`` … in place of their sketches; null
    where a part has no value."""
    kept = [c for c in parts.columns if not any(c == f"{v}_{s}" for v in values for s in ("sketch", "n", "sum", "squares"))]
    made: list[Column] = []
    for c in values:
        n, total, squares = F.col(f"{c}_n"), F.col(f"{c}_sum"), F.col(f"{c}_squares")
        mean = F.when(n > 0, total / n)
        variance = F.when(n > 1, F.greatest((squares - total * mean) / (n - 1), F.lit(0.0)))
        made += [mean.alias(f"mean_{c}"), variance.alias(f"variance_{c}"), F.sqrt(variance).alias(f"stddev_{c}")]
        quantiles = {p: F.when(n > 0, F.kll_sketch_get_quantile_double(f"{c}_sketch", F.lit(float(p)))) for p in percents}
        made += [q.alias(f"P{round(p * 100)}_{c}") for p, q in quantiles.items()]
    return parts.select(*kept, *made)

"""Summaries of a selection: statistics, histograms, evidence and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipquarry.operators.prefix import quantile_row
from clipquarry.session import require_batch

PERCENTS = [0.5, 0.9, 0.99]


def ratio_statistics(df: DataFrame, value: str, one_task_rows: int | None = None) -> DataFrame:
    """One row: mean, population variance, and the 50th, 90th and 99th percentile with linear
    interpolation, all exact. Nulls for no rows."""
    row = quantile_row(df, value, PERCENTS, True, one_task_rows)
    values = [row["mean"], row["var_pop"], row["q0"], row["q1"], row["q2"]]
    names = ["mean", "variance", "P50", "P90", "P99"]
    schema = T.StructType([T.StructField(n, T.DoubleType()) for n in names])
    return df.sparkSession.createDataFrame([values], schema)


def category_statistics(
    df: DataFrame, category: str, duration: str = "duration", exact: bool = False
) -> DataFrame:
    """One row of fifteen statistics of a category's count and density and of the durations.
    Percentiles come from a mergeable sketch in the same pass, or with ``exact`` from two more
    passes that rank the distinct values."""
    source = df.select(
        F.col(f"categories.{category}.count").alias("_count"),
        F.col(f"categories.{category}.density").alias("_density"),
        F.col(duration).alias("_duration"),
    )

    def percentiles(column: str) -> list[Column]:
        if exact:
            row = quantile_row(source, column, PERCENTS, interpolate=False)
            kind = source.schema[column].dataType
            return [F.lit(row[f"q{i}"]).cast(kind) for i in range(len(PERCENTS))]
        found = F.percentile_approx(column, PERCENTS, 10_000)
        return [F.get(found, F.lit(i)) for i in range(len(PERCENTS))]

    def spread(column: str, name: str) -> list[Column]:
        return [
            F.avg(column).alias(f"mean_{name}"),
            F.var_samp(column).alias(f"variance_{name}"),
            F.stddev_samp(column).alias(f"stddev_{name}"),
            *[c.alias(f"{p}_{name}") for c, p in zip(percentiles(column), ("P50", "P90", "P99"))],
        ]

    return source.agg(
        F.sum("_count").alias(f"total_{category}_count"),
        F.avg("_count").alias(f"mean_{category}_count"),
        *spread("_density", f"{category}_density"),
        F.sum("_duration").alias("total_duration"),
        *spread("_duration", "duration"),
    )


def statistics_lines(df: DataFrame) -> DataFrame:
    """Columns of every row as ``key``, ``value`` text; floats with three decimals."""

    def shown(name: str) -> Column:
        text = F.col(name).cast("string")
        if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
            text = F.format_string("%.3f", F.col(name))
        return F.when(F.col(name).isNull(), "None").otherwise(text)

    pairs = [F.struct(F.lit(c).alias("key"), shown(c).alias("value")) for c in df.columns]
    return df.select(F.inline(F.array(*pairs)))


def explode_evidence(df: DataFrame, category: str, key: str = "id") -> DataFrame:
    """One row per piece of evidence; clips without any vanish."""
    return df.select(key, F.explode(f"categories.{category}.evidence").alias("evidence"))


def aggregate_evidence(df: DataFrame, category: str, key: str = "id") -> DataFrame:
    """``key``, ``evidence``, ``n``: every different piece of evidence of an id with how often it stands
    there. Pieces are counted per task before the shuffle, which is on id and piece, so that an id with
    any number of pieces is spread over all tasks."""
    require_batch(df, "aggregate_evidence")
    return explode_evidence(df, category, key).groupBy(key, "evidence").agg(
        F.count(F.lit(1)).alias("n")
    )


def evidence_arrays(counted: DataFrame, key: str = "id") -> DataFrame:
    """The counted pieces as one sorted array per id, for readers that want a row per id. It is a view of
    the counted form: every id becomes one row, which must fit where it is read."""
    repeated = F.flatten(F.collect_list(F.array_repeat("evidence", F.col("n").cast("int"))))
    return counted.groupBy(key).agg(F.sort_array(repeated).alias("aggregated_evidence"))


def merge_histograms(df: DataFrame, histogram: str) -> DataFrame:
    """Counts of all rows' histograms added up per tag; tags without a positive sum drop out.

    The outer form of ``explode`` keeps the optimizer from testing the histogram for emptiness in a
    filter of its own, which would build every histogram twice."""
    return (
        df.select(F.explode_outer(histogram).alias("tag", "n"))
        .filter(F.col("tag").isNotNull())
        .groupBy("tag")
        .agg(F.sum("n").alias("count"))
        .filter(F.col("count") > 0)
    )


def with_total_count(df: DataFrame, out: str = "total_count") -> DataFrame:
    """The number of rows on every row, as a scalar subquery."""
    return df.withColumn(out, df.agg(F.count(F.lit(1))).scalar())


def row_count(df: DataFrame, out: str = "total_rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(out))

"""Budgeted selections: category curation and the clips with the most names in an hours budget."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipquarry.functions.ids import hash_bucket
from clipquarry.operators.budgets import running_budget, take_within_budget
from clipquarry.operators.filters import (
    category_columns,
    category_present,
    quality_filter,
    relabel_selected,
    validate_params,
)
from clipquarry.operators.joins import attach_selection
from clipquarry.operators.ordering import order_by_score
from clipquarry.operators.prefix import broadcast_if_small
from clipquarry.operators.stats import with_total_count
from clipquarry.plans.metrics import document_metrics
from clipquarry.session import freeze

BUCKETS = 20


def _checked(cap: int | None, limit: int) -> int | None:
    if cap is not None and cap < limit:
        raise ValueError(f"a cap of {cap} per bucket can lose rows of a budget of {limit}")
    return cap


def curate_strict(
    clips: DataFrame,
    limit: int = 36_000,
    stat_field: str = "density",
    category: str = "proper_noun",
    text: str = "transcript",
    path: str = "transcoded_filepath",
) -> DataFrame:
    """Strictly filtered clips in order of the category's density or count until ``limit`` seconds
    are reached; then those with at least one hit, with their number, joined to the full rows.

    The texts are read once, for the tests: what passes is stored without them for the budget."""
    validate_params(category, stat_field, path)
    score = "density" if stat_field == "density" else f"{category}_count"
    lifted = category_columns(clips, category, ["id", "duration", text])
    admitted = freeze(quality_filter(lifted, "strict", text).drop(text))
    kept = running_budget(admitted, score, "duration", "final_running_total", (), limit)
    kept = with_total_count(freeze(category_present(kept, f"{category}_count"))).withColumn(
        "total_duration_selected_files", F.col("final_running_total")
    )
    return _attached(clips, kept, category)


def curate_basic(
    clips: DataFrame,
    category: str,
    limit: int = 36_000,
    bucket: Column | None = None,
    cap: int | None = None,
    text: str = "transcript",
    path: str = "transcoded_filepath",
) -> DataFrame:
    """Lightly filtered clips in order of the category's count, cut at ``limit`` seconds over all, with
    the running total in each hash bucket of the id, joined to the full rows. A ``cap`` on that total
    prunes buckets first; it must not be below the limit, or rows of the answer could be lost.

    The texts are read once, for the tests: what passes is stored without them for the budgets."""
    validate_params(category, "count", path)
    cap = _checked(cap, limit)
    count = f"{category}_count"
    bucket = hash_bucket("id", BUCKETS) if bucket is None else bucket
    lifted = category_columns(
        clips.withColumn("_bucket", bucket), category, ["id", "duration", text, path, "_bucket"]
    )
    admitted = freeze(quality_filter(lifted, "basic", text, path, count).drop(text, path))
    per_bucket = "total_duration_selected_files"
    kept = running_budget(admitted, count, "duration", per_bucket, ["_bucket"], cap)
    kept = with_total_count(freeze(category_present(kept.drop("_bucket"), count)))
    kept = running_budget(kept, count, "duration", "final_running_total", (), limit)
    return _attached(clips, kept, category)


def curate_categories(
    clips: DataFrame,
    categories: Sequence[str],
    limit: int = 36_000,
    bucket: Column | None = None,
    cap: int | None = None,
    text: str = "transcript",
    path: str = "transcoded_filepath",
) -> DataFrame:
    """``curate_basic`` for several categories in one job: the texts are read once for the tests, however
    many categories there are. Each clip becomes a row per category after them, and every total is kept
    per category."""
    cap = _checked(cap, limit)
    for category in categories:
        validate_params(category, "count", path)
    fields = ("density", "count", "exists", "evidence")
    per_category = [
        F.struct(
            F.lit(c).alias("category"), *[F.col(f"categories.{c}.{f}").alias(f) for f in fields]
        )
        for c in categories
    ]
    bucket = hash_bucket("id", BUCKETS) if bucket is None else bucket
    lifted = clips.select(
        "id", "duration", text, path, bucket.alias("_bucket"), F.inline(F.array(*per_category))
    )
    admitted = freeze(quality_filter(lifted, "basic", text, path, "count").drop(text, path))
    groups, per_bucket = ["category", "_bucket"], "total_duration_selected_files"
    kept = running_budget(admitted, "count", "duration", per_bucket, groups, cap)
    kept = freeze(category_present(kept.drop("_bucket"), "count"))
    sizes = kept.groupBy("category").agg(F.count(F.lit(1)).alias("total_count"))
    kept = kept.join(broadcast_if_small(sizes), "category")
    kept = running_budget(kept, "count", "duration", "final_running_total", ["category"], limit)
    totals = ["total_duration_selected_files", "total_count", "final_running_total"]
    kept = kept.withColumnsRenamed({f: f"selected_{f}" for f in fields})
    return attach_selection(
        clips, kept, "id", ["category", *[f"selected_{f}" for f in fields], *totals]
    )


def curate(clips: DataFrame, category: str, **options: object) -> DataFrame:
    """The profile the category calls for, ordered by density."""
    if category == "proper_noun":
        return order_by_score(curate_strict(clips, **options), "selected_density", ["id"])
    options.pop("stat_field", None)
    return order_by_score(curate_basic(clips, category, **options), "selected_density", ["id"])


def _attached(clips: DataFrame, kept: DataFrame, category: str) -> DataFrame:
    names = [
        "selected_density",
        *[f"selected_{category}_{f}" for f in ("count", "exists", "evidence")],
        "total_duration_selected_files",
        "total_count",
        "final_running_total",
    ]
    return attach_selection(clips, relabel_selected(kept, category), "id", names)


def select_top_hours(
    df: DataFrame,
    mode: str,
    hours: float = 10,
    key: str = "raw_filepath",
    text: str = "human_transcript_text",
    duration: str = "duration",
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """Key, duration and metrics of the annotated clips with the highest ratio of proper nouns,
    until ``hours`` are filled.

    The metrics are stored once without the texts, so the budget's passes never repeat the
    annotation or re-read a transcript; join the result back with ``join_back``."""
    tie_break = [key] if tie_break is None else list(tie_break)
    carried = list(dict.fromkeys([key, *tie_break, duration]))
    metrics = freeze(
        document_metrics(df, mode, text).select(
            *carried, "proper_noun_ratio", "tag_distribution", "email_count", "phone_count"
        )
    )
    return take_within_budget(metrics, "proper_noun_ratio", duration, hours * 3600, tie_break)


def select_top_segments(
    segments: DataFrame,
    mode: str,
    hours: float = 10,
    key: str = "raw_filepath",
    text: str = "transcript_segment",
    tie_break: Sequence[str] = ("raw_filepath", "start_ms", "end_ms"),
) -> DataFrame:
    """``select_top_hours`` over the annotated rows of ``explode_segments``: key, times, duration and metrics of
    the segments richest in proper nouns. Budget and durations are whole milliseconds. Segments of one
    clip are told apart by their times, so a clip's tied segments can stand or fall alone."""
    millis = (F.col("end_ms") - F.col("start_ms")).cast("long")
    measured = document_metrics(segments.withColumn("duration_ms", millis), mode, text).select(
        *dict.fromkeys([key, *tie_break, "start_ms", "end_ms", "duration_ms"]),
        "proper_noun_ratio", "tag_distribution", "email_count", "phone_count",
    )
    limit = int(hours * 3_600_000)
    return take_within_budget(freeze(measured), "proper_noun_ratio", "duration_ms", limit, list(tie_break))


def for_each_category(tables: dict[str, DataFrame], out: str = "category") -> DataFrame:
    """The category tables as one, each row tagged with its category, so that later steps are one
    job over all of them."""
    tagged = [df.withColumn(out, F.lit(category)) for category, df in tables.items()]
    whole = tagged[0]
    for other in tagged[1:]:
        whole = whole.unionByName(other, allowMissingColumns=True)
    return whole

"""Row filters, quality profiles and category columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipquarry.functions import text as tx
from clipquarry.schema import CATEGORIES, PATH_FIELDS, STAT_FIELDS

PROFILES = ("strict", "basic")
# The clip lengths each profile admits, in seconds.
STRICT_SECONDS = (60, 1200)
BASIC_SECONDS = (0, 1200)
MIN_CHARACTERS = 10


def duration_between(low: int, high: int, duration: str = "duration") -> Column:
    """Inclusive at both ends."""
    return F.col(duration).between(low, high)


def has_path(path: str) -> Column:
    return F.col(path).isNotNull()


def has_category(count: str) -> Column:
    return F.col(count).isNotNull()


def category_present(df: DataFrame, count: str) -> DataFrame:
    """Rows with at least one hit of the category."""
    return df.filter(F.col(count).isNotNull() & (F.col(count) > 0))


def quality_filter(
    df: DataFrame,
    profile: str,
    text: str = "transcript",
    path: str = "transcoded_filepath",
    count: str = "categories.proper_noun.count",
    duration: str = "duration",
) -> DataFrame:
    """The clips a profile admits. Tests are ordered from cheap to dear; the first ones reach the
    scan. In ``strict`` a run of all-caps words needs no test of its own: a single such word already
    rejects the clip."""
    if profile not in PROFILES:
        raise ValueError(f"profile must be one of {PROFILES}")
    if profile == "strict":
        tests = [
            duration_between(*STRICT_SECONDS, duration),
            tx.min_length(text, MIN_CHARACTERS),
            tx.no_music(text),
            tx.not_document_dump(text),
            tx.no_all_caps(text),
            tx.has_sentence_shape(text),
        ]
    else:
        tests = [
            duration_between(*BASIC_SECONDS, duration),
            has_path(path),
            has_category(count),
            tx.min_length(text, MIN_CHARACTERS),
            tx.no_music(text),
        ]
    return df.filter(reduce(lambda a, b: a & b, tests))


def category_columns(df: DataFrame, category: str, keep: Sequence[str]) -> DataFrame:
    """``keep`` and the category's fields, lifted out of the struct."""
    source = f"categories.{category}"
    return df.select(
        *keep,
        F.col(f"{source}.density").alias("density"),
        *[F.col(f"{source}.{f}").alias(f"{category}_{f}") for f in ("count", "exists", "evidence")],
    )


def relabel_selected(df: DataFrame, category: str) -> DataFrame:
    """``density`` and the category's columns renamed to ``selected_…``."""
    names = ["density", *[f"{category}_{f}" for f in ("count", "exists", "evidence")]]
    return df.withColumnsRenamed({n: f"selected_{n}" for n in names})


def prefixed(df: DataFrame, prefix: str = "temp_", exclude: Sequence[str] = ()) -> list[Column]:
    """Every column but ``exclude``, renamed with ``prefix``."""
    return [F.col(c).alias(f"{prefix}{c}") for c in df.columns if c not in exclude]


def project_fields(df: DataFrame, fields: Sequence[str] | None) -> DataFrame:
    """The listed fields that exist, in the listed order; all of them for ``None``."""
    return df if fields is None else df.select(*[f for f in fields if f in df.columns])


def merge_columns(df: DataFrame, metrics: dict[str, Column]) -> DataFrame:
    """The row with the metrics added; a metric replaces a column of its name."""
    return df.withColumns(metrics)


def validate_params(
    category: str, stat_field: str = "density", path_field: str = "transcoded_filepath"
) -> None:
    for name, value, known in (
        ("category", category, CATEGORIES),
        ("category_stat_field", stat_field, STAT_FIELDS),
        ("filepath_field", path_field, PATH_FIELDS),
    ):
        if value not in known:
            raise ValueError(f"unsupported {name} {value!r}; choose from {', '.join(known)}")


def param_problem(category: Column | str, stat_field: Column | str, path_field: Column | str) -> Column:
    """The same test for a table of requested selections: what is wrong with a request's names, null where nothing is."""
    checks = (("category", category, CATEGORIES), ("category_stat_field", stat_field, STAT_FIELDS), ("filepath_field", path_field, PATH_FIELDS))
    found = F.lit(None).cast("string")
    for name, value, known in reversed(checks):
        given = F.col(value) if isinstance(value, str) else value
        wrong = ~F.coalesce(given.isin(*known), F.lit(False))
        found = F.when(wrong, F.concat(F.lit(f"unsupported {name} "), F.coalesce(given, F.lit("null")))).otherwise(found)
    return found

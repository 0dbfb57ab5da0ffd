"""File names, URIs and dataset names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clipquarry.functions.columns import col

_EXTENSION = r"(?s)^\.*[^.].*?(\.[^.]*)$"


def file_name(path: Column | str) -> Column:
    return F.substring_index(col(path), "/", -1)


def extension(path: Column | str) -> Column:
    """Lower-cased, with its dot; empty when there is none. Leading dots are part of the stem."""
    return F.lower(F.regexp_extract(file_name(path), _EXTENSION, 1))


def stem(path: Column | str) -> Column:
    name = file_name(path)
    return F.left(name, F.length(name) - F.length(F.regexp_extract(name, _EXTENSION, 1)))


def split_uri(uri: Column | str) -> Column:
    """``struct<bucket,key>`` of ``gs://bucket/key``."""
    pattern = r"(?s)^(?:gs://)?([^/]*)/(.*)$"
    return F.struct(
        F.regexp_extract(col(uri), pattern, 1).alias("bucket"),
        F.regexp_extract(col(uri), pattern, 2).alias("key"),
    )


def timestamp_suffix(name: Column | str, at: Column | None) -> Column:
    """``name_yyyyMMddHHmmss``; the bare name when no time is given."""
    name = F.lit(name) if isinstance(name, str) else name
    return name if at is None else F.concat_ws("_", name, F.date_format(at, "yyyyMMddHHmmss"))


def dataset_name(category: Column | str, suffix: str) -> Column:
    return F.concat_ws("_", col(category), F.lit(suffix))

"""Manifests: which audio goes where, and the rows that describe it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipquarry.functions.ids import encode_id
from clipquarry.functions.paths import extension, file_name, stem
from clipquarry.operators.joins import merge_update, pair_audio, thinned
from clipquarry.operators.ordering import first_labelled_per_id, number_rows
from clipquarry.session import freeze

# Formats kept as they are, and what others are converted to.
KEPT = [".wav", ".flac"]
CONVERTED = {".m4a": "wav", ".webm": "flac"}


def media_route(
    df: DataFrame,
    bucket: str,
    folder: str,
    path: str = "transcoded_filepath",
    name: Column | None = None,
    transcode: bool = False,
    key: str = "",
) -> DataFrame:
    """``action`` (``copy``, ``convert``, ``skip``), ``target_ext`` and ``destination`` of each clip.
    With ``transcode`` every clip must be converted, and formats without a target are skipped. The name
    is a pseudonym of the stem, salted by the whole path and the private ``key``, so that equal stems in
    different folders or formats do not meet in one destination."""
    name = encode_id(stem(path), key, path) if name is None else name
    ext = extension(path)
    target = F.when(F.lit(not transcode) & ext.isin(KEPT), F.substr(ext, F.lit(2)))
    for source, to in CONVERTED.items():
        target = target.when(ext == source, to)
    action = (
        F.when(target.isNull(), "skip")
        .when(F.lit(not transcode) & ext.isin(KEPT), "copy")
        .otherwise("convert")
    )
    destination = F.concat(F.lit(f"gs://{bucket}/{folder}/"), name, F.lit("."), target)
    return df.withColumns({"action": action, "target_ext": target, "destination": destination})


def skip_existing(routed: DataFrame, listing: DataFrame) -> DataFrame:
    """Conversions whose result is already in the listing become ``reuse``."""
    there = listing.select(F.col("path").alias("destination"), F.lit(True).alias("_there"))
    reused = (F.col("action") == "convert") & F.coalesce(F.col("_there"), F.lit(False))
    return (
        routed.join(there.distinct(), "destination", "left")
        .withColumn("action", F.when(reused, "reuse").otherwise(F.col("action")))
        .drop("_there")
    )


def build_manifest(
    df: DataFrame,
    dataset: str,
    bucket: str,
    folder: str,
    order_by: Sequence[str],
    ascending: bool | Sequence[bool] = True,
    text: str = "transcript",
    path: str = "transcoded_filepath",
    name: Column | None = None,
    transcode: bool = False,
    key: str = "",
) -> DataFrame:
    """``Index, Paths, Labels, Dataset`` of a selection. Skipped clips keep their index, so the
    numbering has gaps."""
    names = [] if name is None else [name.alias("_name")]
    narrow = df.select(*dict.fromkeys([*order_by, text, path]), *names)
    numbered = number_rows(narrow, order_by, ascending)
    name = None if name is None else F.col("_name")
    routed = media_route(numbered, bucket, folder, path, name, transcode, key)
    return routed.filter(F.col("action") != "skip").select(
        "Index",
        F.col("destination").alias("Paths"),
        F.col(text).alias("Labels"),
        F.lit(dataset).alias("Dataset"),
    )


def folder_manifest(
    transcripts: DataFrame,
    audio: DataFrame,
    stored: DataFrame,
    dataset: str,
    name: str = "audio_name",
    text: str = "transcript",
) -> DataFrame:
    """Manifest rows of a folder of transcripts: those with an audio file of their name that is stored
    or at hand. All transcripts are numbered from 0 by name before the others are left out."""
    numbered = number_rows(transcripts.select(name), [name])
    paired = pair_audio(numbered, audio, stored, name)
    return paired.join(transcripts.select(name, text), name).select(
        "Index",
        F.concat(F.lit(f"{dataset}/"), name).alias("Paths"),
        F.col(text).alias("Labels"),
        F.lit(dataset).alias("Dataset"),
    )


def attach_vendor_uri(
    tables: DataFrame, pointers: DataFrame, column: str = "vendor_transcript"
) -> DataFrame:
    """The category tables with the vendor transcript's URI set where the vendor has one."""
    return merge_update(tables, pointers, "id", {column: "transcript_gcs_uri"})


def vendor_manifest(
    tables: DataFrame,
    labels: DataFrame,
    suffix: str,
    order_by: Sequence[str],
    column: str = "vendor_transcript",
    path: str = "transcoded_filepath",
) -> DataFrame:
    """Manifest rows of all category tables in one job: rows are numbered from 0 per category, then
    the first row per id with a vendor transcript is kept. ``labels`` maps ``uri`` to ``label``. Rows
    whose document is missing or malformed are not in it: ``vendor_unmatched`` lists them."""
    needed = dict.fromkeys(["category", "id", path, column, *order_by])
    numbered = number_rows(freeze(tables.select(*needed)), order_by, within=["category"])
    numbered = numbered.withColumn("_id", F.struct("category", "id"))
    first = freeze(first_labelled_per_id(numbered, "_id", column, ["Index"]).drop("_id"))
    dataset = F.concat_ws("_", "category", F.lit(suffix))
    # documents that no row points to are left out before their labels are made
    wanted = freeze(first.select(F.col(column).alias("uri")).distinct())
    usable = thinned(labels, wanted, "uri").filter(F.col("label").isNotNull())
    joined = first.join(usable.select(F.col("uri").alias(column), "label"), column, "inner")
    return joined.select(
        "Index",
        F.concat(dataset, F.lit("/"), file_name(path)).alias("Paths"),
        F.col("label").alias("Labels"),
        dataset.alias("Dataset"),
    )


def vendor_unmatched(
    tables: DataFrame, labels: DataFrame, column: str = "vendor_transcript"
) -> DataFrame:
    """The rows of the category tables that point to a vendor document without a label, with the
    ``reason``: ``missing`` or ``malformed``."""
    known = labels.select(F.col("uri").alias(column), F.col("label").isNotNull().alias("_usable"))
    pointing = tables.filter(F.col(column).isNotNull() & (F.col(column) != ""))
    reason = F.when(F.col("_usable").isNull(), "missing").when(~F.col("_usable"), "malformed")
    found = pointing.join(known, column, "left").withColumn("reason", reason)
    return found.filter(F.col("reason").isNotNull()).select(*tables.columns, "reason")

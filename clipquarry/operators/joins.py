"""Joins of selections, later transcripts and file listings with the tables they came from.

A selection is stored before it is joined, as it is small next to its table and used twice. The table is
thinned in the scan's own tasks, by the keys themselves where they were counted and found small and by a
Bloom filter of them otherwise, so that at most the selection's own rows and few others are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipquarry.operators.filters import prefixed
from clipquarry.operators.keyfilter import key_words, may_hold
from clipquarry.operators.ordering import keep_latest, sample_head
from clipquarry.operators.prefix import broadcast_if_small, fits_broadcast
from clipquarry.session import freeze, require_batch


def thinned(df: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key may be in the stored selection, found in the scan's own tasks: by the keys themselves where they
    were counted and found small, else by a filter of them that lets few other rows pass."""
    keys = stored.select(key)
    if fits_broadcast(keys):
        return df.join(F.broadcast(keys), key, "left_semi")
    return may_hold(df, key, key_words(keys, key, keys.count()))


def join_back(
    orig: DataFrame,
    selected: DataFrame,
    key: str = "raw_filepath",
    text: str = "human_transcript_text",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The original rows with the selection's metrics: all of its columns but key and text as
    ``temp_…``, or just ``columns`` under their own names."""
    if columns is None:
        metrics = selected.select(key, *prefixed(selected, "temp_", [key, text]))
    else:
        metrics = selected.select(key, *columns)
    metrics = freeze(metrics)
    return thinned(orig, metrics, key).join(metrics, key, "inner")


def attach_selection(
    orig: DataFrame, selected: DataFrame, key: str = "id", columns: Sequence[str] | None = None
) -> DataFrame:
    """The original rows of the selected ids with the selection's columns. An id held by several
    rows on both sides gives every pair of them."""
    columns = [c for c in selected.columns if c not in orig.columns] if columns is None else columns
    stored = freeze(selected.select(key, *columns))
    return thinned(orig, stored, key).join(stored, key, "inner")


def restrict_to_keys(
    df: DataFrame,
    keys: DataFrame,
    key: str,
    cap: int | None = None,
    order_by: Sequence[Column | str] | Column | str | None = None,
) -> DataFrame:
    """Rows whose key occurs in ``keys``, optionally only the first ``cap`` of them."""
    stored = freeze(keys.select(key).distinct())
    kept = df.join(broadcast_if_small(stored), key, "left_semi")
    return sample_head(kept, cap, key if order_by is None else order_by)


def overlay(
    orig: DataFrame, selected: DataFrame, key: str, order_by: Sequence[Column | str] | Column | str
) -> DataFrame:
    """Each selected row filled up with the original's other columns. The selection wins where both
    have a column; of several originals the first in ``order_by`` counts; without one the row stays
    as it is."""
    extra = [c for c in orig.columns if c not in selected.columns]
    named = thinned(orig, freeze(selected.select(key)), key)  # only these are ranked
    one_each = keep_latest(named, key, order_by, "_rn").select(key, *extra)
    return selected.join(one_each, key, "left")


def merge_update(
    target: DataFrame, source: DataFrame, key: str, updates: dict[str, str]
) -> DataFrame:
    """``MERGE … WHEN MATCHED THEN UPDATE``: target columns set from source columns on equal keys,
    added as null where the target lacks them. A target row matched by several source rows fails."""
    require_batch(source, "merge_update")
    columns = list(updates.items())
    one_each = (
        source.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("_sources"),
            *[F.first(s).alias(f"_set_{t}") for t, s in columns],
        )
    )
    several = F.raise_error(F.concat(F.lit("merge_update: several source rows for "), F.col(key)))
    checked = F.when(F.col("_sources") > 1, several.cast("boolean")).otherwise(
        F.col("_sources").isNotNull()
    )
    joined = target.join(one_each, key, "left").withColumn("_matched", checked)
    for t, _ in columns:
        kept = F.col(t) if t in target.columns else F.lit(None)
        joined = joined.withColumn(t, F.when(F.col("_matched"), F.col(f"_set_{t}")).otherwise(kept))
    return joined.drop("_sources", "_matched", *[f"_set_{t}" for t, _ in columns])


def present_objects(wanted: DataFrame, listing: DataFrame, path: str = "path") -> DataFrame:
    """The wanted rows whose path is in the listing."""
    return wanted.join(listing.select(F.col("path").alias(path)), path, "left_semi")


def missing_objects(wanted: DataFrame, listing: DataFrame, path: str = "path") -> DataFrame:
    """The wanted rows whose path is not in the listing."""
    return wanted.join(listing.select(F.col("path").alias(path)), path, "left_anti")


def pair_audio(
    transcripts: DataFrame, audio: DataFrame, stored: DataFrame, name: str = "audio_name"
) -> DataFrame:
    """Transcripts with the audio file of their name. ``action`` is ``present`` where the file is
    already stored, ``upload`` where a ``.wav`` or ``.flac`` of the name is at hand; other
    transcripts are left out. ``audio`` and ``stored`` list names in ``name``."""
    at_hand = audio.select(name).distinct().withColumn("_at_hand", F.lit(True))
    in_store = stored.select(name).distinct().withColumn("_stored", F.lit(True))
    action = F.when(F.col("_stored"), "present").when(
        F.col("_at_hand") & (F.endswith(F.col(name), F.lit(".wav")) | F.endswith(F.col(name), F.lit(".flac"))),
        "upload",
    )
    return (
        transcripts.join(in_store, name, "left")
        .join(at_hand, name, "left")
        .withColumn("action", action)
        .filter(F.col("action").isNotNull())
        .drop("_stored", "_at_hand")
    )


def match_spans(
    gold: DataFrame, predicted: DataFrame, keys: Sequence[str] = ("sent_id", "type", "start", "stop")
) -> DataFrame:
    """Spans both sides agree on in every key."""
    return gold.select(*keys).intersect(predicted.select(*keys))

"""Selections written out: the table, the manifest and the reports that go with it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from clipquarry.operators.joins import join_back
from clipquarry.operators.stats import (
    aggregate_evidence,
    category_statistics,
    merge_histograms,
    ratio_statistics,
    statistics_lines,
)
from clipquarry.plans.curation import curate
from clipquarry.plans.manifest import attach_vendor_uri, build_manifest, vendor_manifest, vendor_unmatched
from clipquarry.sources.files import write_manifest
from clipquarry.sources.tables import read_table, table_exists, write_json, write_stats_log, write_table


def publish_top_hours(
    orig: DataFrame,
    selection: DataFrame,
    target: str,
    folder: str,
    fields: Sequence[str] | None = None,
    key: str = "raw_filepath",
    text: str = "human_transcript_text",
) -> DataFrame:
    """Writes the selected rows with their metrics to ``target``, and below ``folder`` the selection's
    ``fields``, the statistics of its ratios and its tag counts, each as JSON of its own."""
    table = write_table(join_back(orig, selection, key, text), target)
    write_json(selection, f"{folder}/selected_data", fields)
    write_json(ratio_statistics(selection, "proper_noun_ratio"), f"{folder}/statistics")
    write_json(merge_histograms(selection, "tag_distribution"), f"{folder}/tag_distribution")
    return table


def publish_category(
    clips: DataFrame,
    category: str,
    target: str,
    dataset: str,
    bucket: str,
    folder: str,
    limit: int = 36_000,
    replace: bool = False,
    text: str = "transcript",
    path: str = "transcoded_filepath",
    **options: object,
) -> DataFrame:
    """Curates a category into the catalog table ``target``. A table that is there already is kept and
    used, unless ``replace``. The manifest, statistics and evidence go below ``folder``."""
    spark = clips.sparkSession
    if not replace and table_exists(spark, target):
        table = read_table(spark, target)
    else:
        chosen = curate(clips, category, limit=limit, text=text, path=path, **options)
        table = write_table(chosen, target, "recreate" if replace else "overwrite")
    order = ["selected_density", "id", path]
    rows = build_manifest(table, dataset, bucket, dataset, order, [False, True, True], text, path)
    write_manifest(rows, f"{folder}/manifest")
    write_stats_log(statistics_lines(category_statistics(table, category)), f"{folder}/statistics")
    write_json(aggregate_evidence(table, category), f"{folder}/evidence")
    return table


def publish_vendor(
    tables: DataFrame,
    pointers: DataFrame,
    labels: DataFrame,
    folder: str,
    suffix: str,
    order_by: Sequence[str],
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The category tables with their vendor transcripts, written partitioned by category; the manifests
    of all categories, partitioned by dataset; and the rows whose vendor document is missing or
    malformed. All three are returned as read back."""
    merged = write_table(attach_vendor_uri(tables, pointers), f"{folder}/tables", partition_by=["category"])
    rows = vendor_manifest(merged, labels, suffix, order_by)
    manifests = write_table(rows, f"{folder}/manifests", partition_by=["Dataset"])
    unmatched = write_table(vendor_unmatched(merged, labels), f"{folder}/unmatched")
    return merged, manifests, unmatched

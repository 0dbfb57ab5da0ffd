"""Filters and metrics are functions of one row and work on a stream as they stand. Budgets,
rankings and numbering need the whole table and refuse one (``require_batch``)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from clipquarry.operators.filters import quality_filter
from clipquarry.plans.metrics import document_metrics


def measured_clips(clips: DataFrame, profile: str, mode: str, text: str = "transcript") -> DataFrame:
    """Quality-filtered clips with their metrics, for batch and streaming input alike."""
    return document_metrics(quality_filter(clips, profile, text), mode, text)

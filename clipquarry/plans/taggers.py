"""Tagger evaluation: from a tagger's raw output to scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipquarry.functions.columns import settled
from clipquarry.functions.tags import (
    align_tokens,
    densify_labels,
    first_subword_labels,
    map_tags,
)
from clipquarry.operators.scoring import span_report


def word_predictions(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """``tokens``, ``gold`` and per sub-token ``word_ids``, ``subword_tags`` to word-level ``pred``
    next to gold tags in the tagger's own names."""
    return df.withColumns(
        {
            "pred": first_subword_labels("word_ids", "subword_tags", F.size("tokens")),
            "gold": map_tags("gold", mapping),
        }
    )


def piece_predictions(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """The same from ``pieces`` and sparse ``entities``: one label per piece, then per word."""
    dense = df.withColumn("_labels", settled(densify_labels("pieces", "entities")))
    return dense.withColumns(
        {
            "pred": align_tokens("tokens", "pieces", "_labels"),
            "gold": map_tags("gold", mapping),
        }
    ).drop("_labels")


def evaluate_words(df: DataFrame, mapping: dict[str, str], by: Sequence[str] = ()) -> DataFrame:
    return span_report(word_predictions(df, mapping), by=by)


def evaluate_pieces(df: DataFrame, mapping: dict[str, str], by: Sequence[str] = ()) -> DataFrame:
    return span_report(piece_predictions(df, mapping), by=by)

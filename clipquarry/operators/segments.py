"""Parts of a transcript: timed segments, dense sections and word blocks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipquarry.functions.columns import let
from clipquarry.functions.tags import runs
from clipquarry.functions.text import strip_text, words


def explode_segments(
    df: DataFrame, segments: str = "human_transcript_timestamps", keep: Sequence[str] = ()
) -> DataFrame:
    """One row per segment: its times, its text as ``transcript_segment``, and its ``duration`` in
    seconds. ``keep`` carries the clip's key along."""
    return df.select(*keep, F.explode(segments).alias("_s")).select(
        *keep,
        F.col("_s.start_ms").alias("start_ms"),
        F.col("_s.end_ms").alias("end_ms"),
        F.col("_s.text").alias("transcript_segment"),
        ((F.col("_s.end_ms") - F.col("_s.start_ms")) / 1000).alias("duration"),
    )


def dense_sections(
    df: DataFrame,
    sentences: str = "sentences",
    threshold: int = 3,
    keep: Sequence[str] = ("start_ms", "end_ms"),
    keep_trailing: bool = False,
) -> DataFrame:
    """One row per run of consecutive sentences with at least ``threshold`` proper nouns, joined by
    a blank. ``sentences`` is ``array<struct<text,proper_nouns>>``. A run still open at the end of
    its segment is left out unless ``keep_trailing``."""
    listed = F.col(sentences)
    found = runs(F.transform(listed, lambda s: s["proper_nouns"] >= threshold))
    if not keep_trailing:
        found = F.filter(found, lambda r: r["stop"] < F.size(listed) - 1)

    def joined(run: Column) -> Column:
        length = run["stop"] - run["start"] + 1
        texts = F.transform(F.slice(listed, run["start"] + 1, length), lambda s: s["text"])
        return strip_text(F.array_join(texts, " "))

    return df.select(*keep, F.posexplode(F.transform(found, joined)).alias("section_no", "section"))


def token_chunks(
    df: DataFrame,
    text: str,
    size: int = 512,
    context: int = 10,
    keep: Sequence[str] = ("id",),
) -> DataFrame:
    """Consecutive blocks of ``size`` words with, apart, the last ``context`` words of the block
    before (whose results a tagger discards)."""
    lead = min(context, size)

    def blocks(word: Column) -> Column:
        def block(i: Column) -> Column:
            first = i * size + 1
            before = F.when(i > 0, F.lit(lead)).otherwise(F.lit(0))
            return F.struct(
                i.alias("chunk"),
                F.slice(word, F.greatest(first - before, F.lit(1)), before).alias("context"),
                F.slice(word, first, F.lit(size)).alias("tokens"),
            )

        last = F.ceil(F.size(word) / size).cast("int") - 1
        return F.when(F.size(word) > 0, F.transform(F.sequence(F.lit(0), last), block))

    return df.select(*keep, F.inline(let(words(text), blocks)))

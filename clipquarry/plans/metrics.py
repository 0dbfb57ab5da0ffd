"""Per-clip metrics and the hook for a caller's tagger."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipquarry.functions import text as tx
from clipquarry.functions.tags import tag_histogram
from clipquarry.operators.segments import token_chunks
from clipquarry.schema import NOUN_LABELS, NOUN_PIECE_TAGS, NOUN_WORD_TAGS

MODES = ("shaped_entities", "tagged_words", "propn_tokens", "entities", "entity_tags")
Tagger = Callable[[Sequence[str]], Sequence[tuple[Sequence[str], Sequence[str]]]]
WordTagger = Callable[[list[list[str]]], Sequence[Sequence[str]]]
CHUNK, CONTEXT, TOGETHER = 512, 10, 32  # words of a chunk, words of context before it, chunks of one call
PORTION = 1 << 20  # bytes of text that a tagger of whole texts gets at once


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _labels(entities: Column) -> Column:
    return F.transform(entities, lambda e: e["label"])


def noun_ratio(mode: str, text: str = "transcript") -> tuple[Column, Column]:
    """Ratio of proper nouns and tag histogram under one of the definitions:

    ``shaped_entities``  one-word capitalised ``entities`` of four labels, per word of the text
    ``tagged_words``     ``tags`` of eight person, corporation, location and group kinds, per word
    ``propn_tokens``     ``pos`` equal to PROPN, per token; every entity label is counted
    ``entities``         ``entities`` of four labels, per token of ``pos``
    ``entity_tags``      ``tags`` of six PER, ORG and LOC kinds, per word

    A null or empty transcript has ratio 0 and an empty histogram."""
    entities, tags, pos = F.col("entities"), F.col("tags"), F.col("pos")
    if mode == "shaped_entities":
        part, whole = F.size(tx.noun_entities(entities, NOUN_LABELS)), tx.word_count(text)
        seen, keep = _labels(entities), NOUN_LABELS
    elif mode == "tagged_words":
        part = F.size(F.filter(tags, lambda t: t.isin(NOUN_WORD_TAGS)))
        whole, seen, keep = tx.word_count(text), tags, NOUN_WORD_TAGS
    elif mode == "propn_tokens":
        part, whole = F.size(F.filter(pos, lambda p: p == "PROPN")), F.size(pos)
        seen, keep = _labels(entities), None
    elif mode == "entities":
        part = F.size(F.filter(entities, lambda e: e["label"].isin(NOUN_LABELS)))
        whole, seen, keep = F.size(pos), _labels(entities), NOUN_LABELS
    elif mode == "entity_tags":
        part = F.size(F.filter(tags, lambda t: t.isin(NOUN_PIECE_TAGS)))
        whole, seen, keep = tx.word_count(text), tags, NOUN_PIECE_TAGS
    else:
        raise ValueError(f"mode must be one of {MODES}")
    spoken = F.coalesce(F.length(text) > 0, F.lit(False))
    ratio = F.when(spoken, _share(part, whole)).otherwise(F.lit(0.0))
    histogram = tag_histogram(F.when(spoken, seen), keep)
    return ratio.cast("double"), histogram


def document_metrics(df: DataFrame, mode: str, text: str = "transcript") -> DataFrame:
    """Each row with ``proper_noun_ratio``, ``tag_distribution``, ``email_count``, ``phone_count``."""
    ratio, histogram = noun_ratio(mode, text)
    return df.withColumns(
        {
            "proper_noun_ratio": ratio,
            "tag_distribution": histogram,
            "email_count": tx.email_count(text),
            "phone_count": tx.phone_count(text),
        }
    )


def portions(texts: pa.Array, most: int = PORTION) -> Iterator[pa.Array]:
    """The array in slices, in order, each of at most ``most`` bytes of text or of one text."""
    first, held = 0, 0
    for i, n in enumerate(pc.binary_length(texts).fill_null(0).to_pylist()):
        if i > first and held + n > most:
            yield texts.slice(first, i - first)
            first, held = i, 0
        held += n
    if first < len(texts):
        yield texts.slice(first)


def annotate(df: DataFrame, make_tagger: Callable[[], Tagger], text: str = "transcript") -> DataFrame:
    """Adds ``tokens`` and ``tags`` from a caller's tagger. ``make_tagger`` runs once per Python
    worker task, so a model is loaded once for all of its batches; the tagger gets a list of texts
    and returns one (tokens, tags) pair for each. A list has at most a mebibyte of text, or one text, as words
    held as Python strings take many times the room of the text.

    The function is declared non-deterministic, as models may be: otherwise a later filter on its
    result would be pushed below it with a second call of the model."""
    strings = pa.list_(pa.string())

    @F.arrow_udf("struct<tokens:array<string>,tags:array<string>>")
    def tagged(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tagger = make_tagger()
        for batch in batches:
            for texts in portions(batch):
                pairs = tagger([t or "" for t in texts.to_pylist()])
                columns = [pa.array([list(p[i]) for p in pairs], strings) for i in (0, 1)]
                yield pa.StructArray.from_arrays(columns, ["tokens", "tags"])

    return (
        df.withColumn("_tagged", tagged.asNondeterministic()(F.col(text)))
        .withColumns({"tokens": F.col("_tagged.tokens"), "tags": F.col("_tagged.tags")})
        .drop("_tagged")
    )


def tag_together(chunks: Iterator[tuple[list[str], list[str]]], tagger: WordTagger, together: int) -> Iterator[list[str]]:
    """The tags of the words of each chunk ``(context, words)``, in order. Chunks go to the tagger ``together`` at a time,
    whichever texts they come from, each with its context before it; what the tagger says of the context is dropped."""
    held: list[tuple[int, list[str]]] = []

    def call() -> Iterator[list[str]]:
        found = tagger([words for _, words in held])
        if len(found) != len(held):
            raise ValueError(f"the tagger was given {len(held)} chunks and returned {len(found)}")
        for (before, words), tags in zip(held, found):
            if len(tags) != len(words):
                raise ValueError(f"the tagger was given {len(words)} words and returned {len(tags)} tags")
            yield list(tags[before:])
        held.clear()

    for context, words in chunks:
        held.append((len(context), context + words))
        if len(held) == together:
            yield from call()
    if held:
        yield from call()


def tag_chunks(
    df: DataFrame,
    make_tagger: Callable[[], WordTagger],
    text: str = "transcript",
    keep: Sequence[str] = ("id",),
    *,
    size: int = CHUNK,
    context: int = CONTEXT,
    together: int = TOGETHER,
) -> DataFrame:
    """``keep``, ``chunk``, ``tokens`` and ``tags``: one row per block of ``size`` words of a text, tagged together with the last
    ``context`` words of the block before. ``make_tagger`` runs once per Python worker task; the tagger gets lists of at
    most ``context + size`` words, ``together`` at a time, and returns one tag per word.

    A text is a stream of rows here, never one value: a task holds one Arrow batch of blocks, however long a text is.
    Texts without words have no row."""
    blocks = token_chunks(df, text, size, context, [*keep]).select(
        F.struct(*keep).alias("row"), "chunk", "context", "tokens"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = make_tagger()
        for batch in batches:
            words = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            tags = pa.array(list(tag_together(words, tagger, together)), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), tags], ["row", "chunk", "tokens", "tags"])

    schema = blocks.select("row", "chunk", "tokens").schema.add("tags", T.ArrayType(T.StringType()))
    return blocks.mapInArrow(run, schema).select("row.*", "chunk", "tokens", "tags")


def annotate_chunked(
    df: DataFrame,
    make_tagger: Callable[[], WordTagger],
    text: str = "transcript",
    *,
    size: int = CHUNK,
    context: int = CONTEXT,
    together: int = TOGETHER,
) -> DataFrame:
    """``df`` with ``tokens`` and ``tags`` of whole texts, from a tagger that takes no more than ``context + size`` words: the
    chunks of :func:`tag_chunks` with their tags put together again in order, in the task that cut them, so nothing is
    shuffled. Chunks of many short texts share a call. Null texts have neither tokens nor tags."""
    strings = pa.list_(pa.string())
    lead = min(context, size)

    @F.arrow_udf("array<string>")
    def tagged(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tagger = make_tagger()
        for batch in batches:
            lengths = [len(words) if words.is_valid else None for words in batch]

            def chunks() -> Iterator[tuple[list[str], list[str]]]:
                for words, n in zip(batch, lengths):
                    for first in range(0, n or 0, size):
                        yield words.values[max(first - lead, 0):first].to_pylist(), words.values[first:first + size].to_pylist()

            found, out = tag_together(chunks(), tagger, together), []
            for n in lengths:
                tags: list[str] | None = None if n is None else []
                while n and len(tags) < n:
                    tags += next(found)
                out.append(tags)
            yield pa.array(out, strings)

    split = df.withColumn("tokens", tx.words(text))
    return split.withColumn("tags", tagged.asNondeterministic()(F.col("tokens")))

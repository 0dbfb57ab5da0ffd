"""Resampling towards a target distribution, by importance weights over hashed word n-grams.

Two passes over the texts: one counts the features of all documents in a fixed number of buckets, the other adds up
the gains of a document's features from an array with one gain per bucket. Gumbel noise from a hash of the id turns
weights into a draw without replacement: the highest scores win.

The cutoff between winners and the rest is found by a weighted median of medians. Every task gives the median key of
its keys that are still open, weighted by their number; at least a quarter of all open keys lies on either side of
the weighted median of these, so each round discards that much, and one pass serves both the count on either side
and the medians of the next round. Only winners are sorted."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipquarry.llm.common import store
from clipquarry.llm.decontaminate import words_of
from clipquarry.operators.ordering import number_rows

BUCKETS = 10_000
LONGEST = 3
SEED = 42
SCALE = 1_000  # scores are whole thousandths
LEAST_WORDS = 20
PERCENT = 5
RESTORE = 4  # open keys are stored anew when they have become fewer by this factor
SLICE = 512  # documents whose features are held at once


def feature_buckets(words: list[bytes], buckets: int, longest: int) -> np.ndarray:
    """The buckets of all runs of 1 to ``longest`` words joined by blanks. A CRC is carried on from the run that is
    one word shorter, so no run is ever put together."""
    if not words:
        return np.zeros(0, np.int64)
    run, tails, found = list(map(crc32, words)), [b" " + w for w in words], []
    for n in range(1, longest + 1):
        found += run
        run = list(map(crc32, tails[n:], run))
    return np.array(found, np.uint32).astype(np.int64) % buckets


def count_buckets(docs: DataFrame, *, text: str = "text", buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """Features of all texts by bucket. Tasks hand over one count per bucket; these are summed by Spark, and as many
    numbers as there are buckets reach the driver."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE):
                texts = batch.column(0).slice(i, SLICE).to_pylist()
                found = [feature_buckets(words_of(t), buckets, longest) for t in texts]
                total += np.bincount(np.concatenate(found), minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    rows = docs.select(F.col(f"`{text}`").cast("string")).mapInArrow(counted, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for row in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Of each bucket: how much likelier the target has it, as a whole number of thousandths of a natural logarithm,
    with one more feature in every bucket of both."""
    n = len(documents)
    s_all, t_all = float(documents.sum()) + n, float(target.sum()) + n
    return np.array(
        [
            math.floor(SCALE * math.log(((float(t) + 1) * s_all) / ((float(s) + 1) * t_all)))
            for s, t in zip(documents.tolist(), target.tolist())
        ],
        np.int64,
    )


def gumbel(doc_id: int | None, seed: int) -> int:
    """Noise of an id in thousandths; a null id counts as empty text."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-SCALE * math.log(-math.log((h + 0.5) / 4294967296)))


def score_documents(
    docs: DataFrame,
    gain: np.ndarray,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    longest: int = LONGEST,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features``, ``weight`` (sum of the gains of a text's features) and ``score`` (the weight
    and the noise of the id) of every row. Null and empty texts have no features and weigh 0."""
    buckets, names = len(gain), ["doc_id", "n_words", "n_features", "weight", "score"]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out = batch.column(0).to_pylist(), []
            for i, text in zip(ids, batch.column(1)):
                words = words_of(text.as_py())
                found = feature_buckets(words, buckets, longest)
                weight = int(gain[found].sum())
                out.append((i, len(words), len(found), weight, weight + gumbel(i, seed)))
            columns = zip(*out) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    rows = docs.select(F.col(f"`{doc_id}`").cast("long"), F.col(f"`{text}`").cast("string"))
    return rows.mapInArrow(scored, ", ".join(f"{c} long" for c in names))


# -- selection --------------------------------------------------------------------------------------------------------

Key = tuple[int, ...]


@dataclass
class Side:
    """Open keys on one side of a pivot, as the tasks see them: how many, and their median."""

    sizes: list[int]
    medians: list[Key]

    def pivot(self) -> Key:
        """The weighted median: half of the weight is at or before it, half at or behind it."""
        left, half = 0, (sum(self.sizes) + 1) // 2
        for key, n in sorted(zip(self.medians, self.sizes)):
            left += n
            if left >= half:
                return key
        raise ValueError("no open keys")


def _before(keys: np.ndarray, pivot: Key) -> np.ndarray:
    """-1, 0 or 1 for each row of ``keys``: before, at or behind the pivot."""
    out = np.zeros(len(keys), np.int8)
    for column, p in zip(keys.T, pivot):
        open_ = out == 0
        out[open_ & (column < p)] = -1
        out[open_ & (column > p)] = 1
    return out


def _median(keys: np.ndarray) -> Key:
    order = np.lexsort(keys.T[::-1])
    return tuple(keys[order[(len(keys) - 1) // 2]].tolist())


def _round(keys: DataFrame, low: Key | None, high: Key | None, pivot: Key | None) -> tuple[Side, Side, int]:
    """Of the keys between ``low`` and ``high`` (both left out), those before and behind the pivot, and whether it is there.
    Without a pivot all count as before it. One row per task comes back."""
    width = len(keys.columns)

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            rows = np.column_stack([np.asarray(c) for c in batch.columns])
            keep = np.ones(len(rows), bool)
            if low is not None:
                keep &= _before(rows, low) > 0
            if high is not None:
                keep &= _before(rows, high) < 0
            held.append(rows[keep])
        rows = np.concatenate(held) if held else np.zeros((0, width), np.int64)
        side = np.full(len(rows), -1, np.int8) if pivot is None else _before(rows, pivot)
        first, last = rows[side < 0], rows[side > 0]
        none = [None] * width
        made = [len(first), len(last), int((side == 0).sum()), _median(first) if len(first) else none, _median(last) if len(last) else none]
        types = [pa.int64()] * 3 + [pa.list_(pa.int64())] * 2
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(made, types)], ["a", "b", "at", "x", "y"])

    rows = keys.mapInArrow(seen, "a long, b long, at long, x array<long>, y array<long>").collect()
    sides = [Side([r[n] for r in rows if r[n]], [tuple(r[m]) for r in rows if r[n]]) for n, m in (("a", "x"), ("b", "y"))]
    return sides[0], sides[1], sum(r["at"] for r in rows)


def cutoff(keys: DataFrame, k: int) -> Key | None:
    """The ``k``-th smallest row of ``keys``, whose columns are longs that are never null and whose rows are distinct, in
    the order of the columns; None for no ``k``. Rows of the driver: one per task and round."""
    side, _, _ = _round(keys, None, None, None)
    total = stored = sum(side.sizes)
    if not 0 < k <= total:
        return None
    low = high = None
    while True:
        pivot = side.pivot()
        first, last, at = _round(keys, low, high, pivot)
        before = sum(first.sizes)
        if k <= before:
            side, high = first, pivot
        elif k <= before + at:
            return pivot
        else:
            side, low, k = last, pivot, k - before - at
        if sum(side.sizes) * RESTORE < stored:
            stored, names = sum(side.sizes), keys.columns
            keys = store(keys.where(_between(names, low, high)), "open_keys")


def _between(names: list[str], low: Key | None, high: Key | None):
    """Open keys as a condition; the bound on the first column reaches the Parquet scan."""
    row, out = F.struct(*names), F.lit(True)
    for bound, first, all_ in ((low, "__ge__", "__gt__"), (high, "__le__", "__lt__")):
        if bound is not None:
            key = F.struct(*[F.lit(b).cast("long").alias(n) for b, n in zip(bound, names)])
            out = out & getattr(F.col(names[0]), first)(bound[0]) & getattr(row, all_)(key)
    return out


def resample(
    docs: DataFrame,
    target: DataFrame,
    *,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS,
    longest: int = LONGEST,
    seed: int = SEED,
    doc_id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
) -> DataFrame:
    """Every row's ``doc_id``, ``n_features``, ``weight``, ``score`` and ``rank``: 1, 2, 3 … for the ``percent`` in a hundred (rounded
    down) highest scores of the rows with at least ``least_words`` words, null for the others. Ties go to the smaller
    id, then to fewer features; null ids come first. Rows that agree in all this are interchangeable, each is
    drawn on its own.

    Null texts have no words. An empty table gives no rows; without a target every bucket counts as empty there."""
    counted = {"buckets": buckets, "longest": longest}
    gain = gains(count_buckets(docs, text=text, **counted), count_buckets(target, text=target_text, **counted))
    scored = score_documents(docs, gain, doc_id=doc_id, text=text, longest=longest, seed=seed)
    rows = store(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    able = F.col("n_words") >= least_words
    key = {
        "k0": -F.col("score"),
        "k1": F.col("doc_id").isNotNull().cast("long"),
        "k2": F.coalesce("doc_id", F.lit(0).cast("long")),
        "k3": F.col("n_features"),
        "k4": F.col("row"),
    }
    keyed = rows.where(able).select(*[c.alias(n) for n, c in key.items()])
    edge = cutoff(keyed, keyed.count() * percent // 100)
    result = ["doc_id", "n_features", "weight", "score"]
    if edge is None:
        return rows.select(*result, F.lit(None).cast("long").alias("rank"))
    last = F.struct(*[F.lit(e).cast("long").alias(n) for e, n in zip(edge, key)])
    drawn = able & (F.col("score") >= -edge[0]) & (F.struct(*[c.alias(n) for n, c in key.items()]) <= last)
    ranked = number_rows(rows.where(drawn).select(*result, "row"), ["score", "doc_id", "n_features", "row"], [False, True, True, True], "rank")
    ranked = ranked.select(*result, (F.col("rank") + 1).alias("rank"))
    return ranked.unionByName(rows.where(~drawn).select(*result, F.lit(None).cast("long").alias("rank")))

"""A quality classifier: ordinal regression with a cumulative logit link.

Texts are graded on an ordered scale. One vector of weights over hashed features of the text is shared by all
grades; ordered thresholds cut the scale: P(grade > k) = sigmoid(w.x - theta_k). That gives the expected grade and
the probability of the upper tail, by which documents are selected.

Features are the words and their shapes (runs of upper case, lower case, digits and each mark), by their share
of the text, and steps of a few ratios: different words, repeated neighbours, repeated lines, length of words.

The fit takes at most ``SAMPLE_ROWS`` documents of each grade; everything is scored."""

from __future__ import annotations

import math
import pickle
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipquarry.llm.common import WORKER_CACHE, fresh, labelled_sample, released, trained

SAMPLE_ROWS = 3_000  # documents of each grade that are learned from, at most
DIMENSIONS = 1 << 18
STEPS, RATE, DECAY = 150, 0.2, 1e-5
LEAST_TAIL = 0.2  # documents below are rejected
_RUNS = re.compile(r"([A-Z])[A-Z]*|([a-z])[a-z]*|([0-9])[0-9]*|(.)\4*", re.S)


def _hash(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "surrogatepass")) % DIMENSIONS


def shape(word: str) -> str:
    """X for a run of upper case, x for lower case, 9 for digits, and each mark once."""
    plain = "".join("A" if c.isupper() else "a" if c.isalpha() else c for c in word) if not word.isascii() else word
    out = [("X" if m[1] else "x" if m[2] else "9" if m[3] else m[4]) for m in _RUNS.finditer(plain)]
    return "".join(out)[:16]


def word_features(word: str) -> tuple[int, int]:
    return _hash("w=" + word.lower()), _hash("s=" + shape(word))


def text_features(text: str, words: list[str]) -> list[int]:
    """Steps of ratios of the whole text."""
    n = max(len(words), 1)
    lines = [x for x in text.split("\n") if x]
    steps = {
        "different": int(10 * len(set(words)) / n),
        "neighbours": int(20 * sum(a == b for a, b in zip(words, words[1:])) / n),
        "lines": int(10 * len(set(lines)) / max(len(lines), 1)),
        "letters": int(len(text) / n),
        "size": int(math.log2(n)),
        "top": int(10 * max(Counter(words).values(), default=0) / n),
    }
    return [_hash(f"{k}={v}") for k, v in steps.items()]


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def fit(batches: Iterator[pa.RecordBatch]) -> bytes:
    """A model of (label, text) rows: the grades, the weights, the thresholds."""
    rows, columns, values, grades, memo = [], [], [], [], {}
    for batch in batches:
        for grade, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words, counts = (text or "").split(), Counter()
            for w, n in Counter(words).items():
                found = memo.get(w) or memo.setdefault(w, word_features(w))
                for f in found:
                    counts[f] += n / len(words)
            counts.update(text_features(text or "", words))
            rows += [len(grades)] * len(counts)
            columns += counts.keys()
            values += counts.values()
            grades.append(grade)
    scale = sorted(set(grades))
    if len(scale) < 2:  # nothing to tell apart: every text gets the one grade
        return pickle.dumps({"grades": scale or [1], "weights": np.zeros(DIMENSIONS, np.float32), "thresholds": np.zeros(0)})
    row, column, value = np.array(rows), np.array(columns), np.array(values)
    y = np.searchsorted(scale, grades)
    share = np.bincount(y, minlength=len(scale)) / len(y)
    above = 1 - np.cumsum(share)[:-1]
    first, gaps = float(-np.log(above[0] / (1 - above[0]))), np.zeros(len(scale) - 2)
    weights = np.zeros(DIMENSIONS)
    state = [np.full(DIMENSIONS, 1e-6), 1e-6, np.full(len(gaps), 1e-6)]
    balance = (1 / share / len(scale))[y]  # each grade weighs the same
    for _ in range(STEPS):
        theta = first + np.concatenate(([0.0], np.cumsum(np.exp(gaps))))
        z = np.bincount(row, weights[column] * value, len(y))
        upper = np.column_stack([np.ones(len(y)), _sigmoid(z[:, None] - theta), np.zeros(len(y))])  # P(grade >= k)
        p = np.maximum(upper[np.arange(len(y)), y] - upper[np.arange(len(y)), y + 1], 1e-12)
        slope = upper * (1 - upper)
        by_low, by_high = slope[np.arange(len(y)), y] / p * balance, slope[np.arange(len(y)), y + 1] / p * balance
        dz = by_low - by_high
        # the lower bound of grade k is threshold k - 1, the upper one threshold k
        dtheta = np.bincount(y, by_high, len(scale))[:-1] - np.bincount(y, by_low, len(scale))[1:]
        tails = np.cumsum(dtheta[::-1])[::-1]
        grads = [
            np.bincount(column, dz[row] * value, DIMENSIONS) - DECAY * len(y) * weights,
            tails[0],
            tails[1:] * np.exp(gaps),
        ]
        moved = []
        for i, g in enumerate(grads):
            state[i] = state[i] + g * g
            moved.append(RATE * g / np.sqrt(state[i]))
        weights, first, gaps = weights + moved[0], first + float(moved[1]), gaps + moved[2]
    theta = first + np.concatenate(([0.0], np.cumsum(np.exp(gaps))))
    return pickle.dumps({"grades": scale, "weights": weights.astype(np.float32), "thresholds": theta})


class Grader:
    """Scores texts with a fitted model; what a distinct word adds is computed once while remembered."""

    def __init__(self, model: bytes) -> None:
        self.__dict__.update(pickle.loads(model))
        self.memo: dict[str, float] = {}

    def score(self, text: str | None) -> tuple[float, float]:
        """The expected grade and the probability of more than the lowest grade."""
        text, memo, weights = text or "", self.memo, self.weights
        words = text.split()
        if len(memo) > WORKER_CACHE:
            memo.clear()
        try:
            z = sum(map(memo.__getitem__, words))
        except KeyError:
            for w in set(words).difference(memo):
                a, b = word_features(w)
                memo[w] = float(weights[a]) + float(weights[b])
            z = sum(map(memo.__getitem__, words))
        z = z / max(len(words), 1) + float(weights[text_features(text, words)].sum())
        upper = _sigmoid(z - self.thresholds)
        expected = self.grades[0] + float((upper * np.diff(self.grades)).sum())
        return expected, float(upper[0]) if len(upper) else 1.0


def train(
    docs: DataFrame, labels: DataFrame, *, rows: int = SAMPLE_ROWS, doc_id: str = "doc_id", label: str = "quality"
) -> bytes:
    """A model of the documents that ``labels`` grades. With fewer than two grades every text is kept."""
    return trained(labelled_sample(docs, labels, rows, doc_id=doc_id, label=label), fit)


def score_quality(docs: DataFrame, model: bytes, *, carry: list[str] | None = None, text: str = "text") -> DataFrame:
    """The columns ``carry`` of ``docs`` (default: all) as struct ``row``, with ``expected_grade`` and
    ``tail_probability`` (of more than the lowest grade). Null texts are graded as empty ones, by the features of an
    empty text. Ids are not read: null and repeated rows are graded like any others. An empty table gives an empty one."""
    carry = docs.columns if carry is None else carry
    row = F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row")
    rows = docs.select(row) if text in carry else docs.select(row, F.col(text).alias("text"))
    added = T.DataType.fromDDL("expected_grade double, tail_probability double")
    schema = T.StructType([rows.schema["row"], *added.fields])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @released
    def graded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grader = Grader(shared.value)
        for batch in batches:
            row = batch.column(0)
            texts = row.flatten()[carry.index(text)] if text in carry else batch.column(1)
            found = np.array([grader.score(t.as_py()) for t in texts]).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([row, pa.array(found[:, 0]), pa.array(found[:, 1])], ["row", "expected_grade", "tail_probability"])

    return rows.mapInArrow(graded, schema)


def select_quality(docs: DataFrame, model: bytes, *, least_tail: float = LEAST_TAIL, **options) -> DataFrame:
    """The documents whose upper tail is at least ``least_tail``, with their own columns."""
    return score_quality(docs, model, **options).where(F.col("tail_probability") >= least_tail).select("row.*")

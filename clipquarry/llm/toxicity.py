"""Toxic spans from a linear-chain conditional random field.

Tokens are clean (0) or toxic (1). Training tokens get their labels from labelled documents: a word is an offence
if it stands behind several different words in toxic documents, and behind far more than in clean ones; its tokens
in toxic documents are toxic. Counting what stands before a word, not documents, keeps the rare words of a
toxic text and its near copies apart from offences. The field has hashed features of a token (the word, its beginnings and ends) and a
matrix of transitions; both are fitted on the exact log-likelihood, whose gradient is marginals less labels.

To score a text, forward and backward messages run over its whole chain of tokens; the marginals of tokens
that are more likely toxic than not make the spans. A logistic function of their sum and their largest, fitted on the
same sample, gives the document's score. Messages are logarithms of ratios, one number per document and
place, and run for all documents of an Arrow batch at once.

The fit takes at most ``SAMPLE_ROWS`` documents of each label; everything is scored."""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipquarry.llm.common import WORKER_CACHE, labelled_sample, trained

SAMPLE_ROWS = 3_000  # documents of each label that are learned from, at most
DIMENSIONS = 1 << 18
AFFIXES = (3, 4, 5, 6)
LEAST_CONTEXTS = 3  # different words before it that an offence must have in toxic documents
RATIO = 20.0  # times those per clean document
STEPS, RATE, DECAY = 60, 0.3, 2e-6
PIECE, PIECES = 64, 12_000  # tokens of a training piece; pieces with and without an offence, at most
THRESHOLD = 0.7
WORD = re.compile(r"\w+")


def features(word: str) -> list[int]:
    """Hashed features of a token."""
    found = [f"w={word}"]
    for n in AFFIXES:
        if len(word) >= n:
            found += [f"p={word[:n]}", f"s={word[-n:]}"]
    return [zlib.crc32(f.encode("utf-8", "surrogatepass")) % DIMENSIONS for f in found]


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def _pass(ratio: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """The log-ratio that a message carries over a transition, from the log-ratio before it. ``trans[a, b]``: a to b."""
    return np.logaddexp(trans[0, 1], ratio + trans[1, 1]) - np.logaddexp(trans[0, 0], ratio + trans[1, 0])


def messages(emission: np.ndarray, lengths: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward (with the own emission) and backward log-ratios of chains that stand one behind the other."""
    ends = np.cumsum(lengths)
    order = np.argsort(-lengths, kind="stable")
    starts, sizes = (ends - lengths)[order], lengths[order]
    longest = int(sizes[0]) if len(sizes) else 0
    active = len(sizes) - np.searchsorted(sizes[::-1], np.arange(longest), "right")
    forward, backward = np.zeros_like(emission), np.zeros_like(emission)
    for t in range(longest):
        at = starts[:active[t]] + t
        forward[at] = emission[at] if t == 0 else emission[at] + _pass(forward[at - 1], trans)
    back = np.ascontiguousarray(trans.T)
    for t in range(longest - 2, -1, -1):
        at = starts[:active[t + 1]] + t
        backward[at] = _pass(backward[at + 1] + emission[at + 1], back)
    return forward, backward


def marginals(emission: np.ndarray, lengths: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Of each token the probability that it is toxic."""
    forward, backward = messages(emission, lengths, trans)
    return _sigmoid(forward + backward)


def expectations(emission: np.ndarray, lengths: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The marginals, and the expected numbers of transitions a to b."""
    forward, backward = messages(emission, lengths, trans)
    right = _not_first(lengths)
    f, b = forward[right - 1], (backward + emission)[right]
    logs = np.stack([np.full_like(f, trans[0, 0]), trans[0, 1] + b, trans[1, 0] + f, trans[1, 1] + f + b])
    p = np.exp(logs - logs.max(axis=0))
    return _sigmoid(forward + backward), (p / p.sum(axis=0)).sum(axis=1).reshape(2, 2)


def _not_first(lengths: np.ndarray) -> np.ndarray:
    """Places of the tokens that have one before them in their chain."""
    first = np.zeros(int(lengths.sum()), bool)
    first[(np.cumsum(lengths) - lengths)[lengths > 0]] = True
    return np.flatnonzero(~first)


def fit(batches: Iterator[pa.RecordBatch]) -> bytes:
    """A model of (label, text) rows: weights, bias, transitions, document coefficients."""
    vocabulary: dict[str, int] = {}
    chains, labels, seen, contexts = [], [], set(), ([], [])
    for batch in batches:
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = WORD.findall(text.lower()) if text else []
            chain = np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words], np.int32)
            if (mark := hash(chain.tobytes())) not in seen:  # copies say nothing new about words
                seen.add(mark)
                before = np.concatenate(([-1], chain[:-1])).astype(np.int64)[:len(chain)]
                contexts[label > 0].append(np.unique(before << 32 | chain))
                chains.append(chain)
                labels.append(int(label > 0))
    names = list(vocabulary)
    model = {"weights": np.zeros(DIMENSIONS, np.float32), "bias": -8.0, "trans": np.zeros((2, 2)), "doc": [-6.0, 0.0, 0.0]}
    n1, n0 = sum(labels), len(labels) - sum(labels)
    clean, bad = (
        np.bincount(np.unique(np.concatenate(c)) & 0xFFFFFFFF, minlength=len(names)) if c else np.zeros(len(names))
        for c in contexts
    )
    offences = np.flatnonzero((bad >= LEAST_CONTEXTS) & (bad / max(n1, 1) > RATIO * (clean + 0.5) / max(n0, 1)))
    if not offences.size or not n0:
        return pickle.dumps(model)
    lengths = np.array([len(c) for c in chains])
    flat = np.concatenate(chains)
    toxic = np.repeat(np.array(labels) > 0, lengths) & np.isin(flat, offences)
    # the field is fitted on pieces of chains: all with an offence, and as many others by a hash
    cuts = [(a, min(PIECE, n - a), start + a) for n, start in zip(lengths, np.cumsum(lengths) - lengths) for a in range(0, n, PIECE)]
    dirty = np.add.reduceat(toxic, [c[2] for c in cuts]) > 0
    others = sorted((k for k in range(len(cuts)) if not dirty[k]), key=lambda k: zlib.crc32(flat[cuts[k][2]:cuts[k][2] + cuts[k][1]].tobytes()))
    chosen = [cuts[k] for k in sorted([*np.flatnonzero(dirty)[:PIECES].tolist(), *others[:PIECES]])]
    sizes = np.array([c[1] for c in chosen])
    at = np.concatenate([np.arange(c[2], c[2] + c[1]) for c in chosen])
    words, gold = flat[at], toxic[at].astype(float)
    # the words as rows of a matrix of hashed features
    hashed = [features(w) for w in names]
    owner, column = np.repeat(np.arange(len(names)), [len(h) for h in hashed]), np.concatenate(hashed)
    weights, bias, trans = np.zeros(DIMENSIONS), -4.0, np.zeros((2, 2))
    state = [np.full(DIMENSIONS, 1e-6), 1e-6, np.full((2, 2), 1e-6)]
    right = _not_first(sizes)
    counted = np.bincount((2 * gold[right - 1] + gold[right]).astype(int), minlength=4).reshape(2, 2)
    for _ in range(STEPS):
        emission = (bias + np.bincount(owner, weights[column], len(names)))[words]
        m, expected = expectations(emission, sizes, trans)
        by_word = np.bincount(words, gold - m, len(names))
        grads = [
            np.bincount(column, by_word[owner], DIMENSIONS) - DECAY * len(words) * weights,
            by_word.sum(),
            counted - expected,
        ]
        moved = []
        for i, g in enumerate(grads):
            state[i] = state[i] + g * g
            moved.append(RATE * g / np.sqrt(state[i]))
        weights, bias, trans = weights + moved[0], bias + moved[1], trans + moved[2]
        trans = trans - trans[0, 0]  # only differences matter
    model |= {"weights": weights.astype(np.float32), "bias": float(bias), "trans": trans}
    emission = (bias + np.bincount(owner, weights[column], len(names)))[flat]
    model["doc"] = _fit_document(_summaries(marginals(emission, lengths, trans), lengths), np.array(labels))
    return pickle.dumps(model)


def _summaries(m: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Of each document the logarithm of its expected toxic tokens, among those more likely toxic than
    not, and its largest marginal."""
    tagged = np.where(m >= 0.5, m, 0.0)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    most = np.zeros(len(lengths))
    np.maximum.at(most, owner, m)
    return np.stack([np.log1p(np.bincount(owner, tagged, len(lengths))), most], axis=1)


def _fit_document(x: np.ndarray, y: np.ndarray) -> list[float]:
    """Logistic regression with a small penalty, by Newton steps."""
    design, c = np.column_stack([np.ones(len(x)), x]), np.zeros(3)
    for _ in range(30):
        p = _sigmoid(design @ c)
        h = (design * (p * (1 - p))[:, None]).T @ design + 0.05 * np.eye(3)
        c = c + np.linalg.solve(h, design.T @ (y - p) - 0.05 * c)
    return c.tolist()


class Tagger:
    """Scores texts with a fitted model; the emission of a distinct word is computed once while remembered."""

    def __init__(self, model: bytes) -> None:
        self.__dict__.update(pickle.loads(model))
        self.memo: dict[str, float] = {}

    def emissions(self, words: list[str]) -> np.ndarray:
        memo = self.memo
        if len(memo) > WORKER_CACHE:
            memo.clear()
        for w in set(words).difference(memo):
            memo[w] = self.bias + float(self.weights[features(w)].sum())
        return np.fromiter(map(memo.__getitem__, words), np.float64, len(words))

    def score(self, texts: list[str | None]) -> tuple[np.ndarray, list[list[tuple[int, int, float]]]]:
        """Of each text its score and its spans: (start, end, largest marginal), offsets in characters."""
        parts = [self.emissions(WORD.findall(t.lower())) if t else np.zeros(0) for t in texts]
        lengths = np.array([len(p) for p in parts], np.int64)
        m = marginals(np.concatenate(parts) if parts else np.zeros(0), lengths, self.trans)
        x = _summaries(m, lengths)
        scores = _sigmoid(self.doc[0] + x @ np.array(self.doc[1:]))
        spans, ends = [], np.cumsum(lengths)
        for text, a, b in zip(texts, ends - lengths, ends):
            own = m[a:b] >= 0.5
            found: list[tuple[int, int, float]] = []
            if own.any():
                # lower() may change the length of a text: offsets are those of the text as it is
                places = [(w.start(), w.end()) for w in WORD.finditer(text)]
                if len(places) != len(own):
                    places = [(w.start(), w.end()) for w in WORD.finditer(text.lower())]
                before = -2
                for k in np.flatnonzero(own).tolist():
                    start, end = places[k]
                    p = float(m[a + k])
                    if k == before + 1:
                        found[-1] = (found[-1][0], end, max(found[-1][2], p))
                    else:
                        found.append((start, end, p))
                    before = k
            spans.append(found)
        return scores, spans


def train(
    docs: DataFrame, labels: DataFrame, *, rows: int = SAMPLE_ROWS, doc_id: str = "doc_id", label: str = "toxic"
) -> bytes:
    """A model of the documents that ``labels`` marks. Without an offence to learn every text scores low."""
    return trained(labelled_sample(docs, labels, rows, doc_id=doc_id, label=label), fit)


def score_toxicity(
    docs: DataFrame, model: bytes, *, threshold: float = THRESHOLD, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id``, ``score``, ``predicted`` (1 if the score is at least ``threshold``) and ``spans`` (``start``, ``end``,
    ``score``) per row. Null and empty texts have no token: the lowest score and no span. Null and repeated ids
    stay as they are; other columns are not read; an empty table gives an empty one."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = (
        f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double, "
        "spans array<struct<start:int,end:int,score:double>>"
    )
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(shared.value)
        for batch in batches:
            scores, spans = tagger.score(batch.column(1).to_pylist())
            listed = [[{"start": a, "end": b, "score": p} for a, b, p in s] for s in spans]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(listed, kind)], ["doc_id", "score", "spans"])

    found = rows.mapInArrow(scored, schema)
    return found.select("doc_id", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "spans")

"""Fingerprints of Lempel-Ziv phrases, for a likeness near that of compressing two texts together.

A text's UTF-8 bytes are parsed into phrases: each is the longest one already in the dictionary and one byte more, and is
put into the dictionary (a trie). The set of phrases is hashed, and a fingerprint keeps of each of ``BINS`` ranges of
hashes one byte of the smallest hash in it (0: none). Likeness is the share of occupied bins that agree, less
what agrees by chance, which estimates the Jaccard similarity of the sets of phrases.

A dictionary that is full starts anew, so that memory is bounded in texts of any length. Parsing runs from left to right,
so an edited text that keeps its first part goes on from the dictionary at the end of that part."""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 256
VALUES = 255  # of an occupied bin
DICTIONARY = 1 << 20  # phrases
SLAB = 1 << 20  # bytes whose phrases are hashed at once
KEPT = 4  # the edited text replaces the last of so many parts
FLUSH = 512  # rows of a batch that is handed on
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2 ** 64
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, modulo 2 ** 64."""
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            grown = np.full(1 << (n - 1).bit_length(), base, np.uint64)
            grown[0] = 1
            _POWERS[k] = np.cumprod(grown)
    return _POWERS[0][:n], _POWERS[1][:n]


class Parse:
    """Phrases of a text that may be read piece by piece: where they end, and the dictionary."""

    def __init__(self) -> None:
        self.trie: dict[int, int] = {}
        self.node, self.ends, self.read = 0, [], 0

    def fork(self) -> Parse:
        other = Parse()
        other.trie, other.node, other.ends, other.read = dict(self.trie), self.node, list(self.ends), self.read
        return other

    def feed(self, data: bytes) -> Parse:
        trie, node, ends, at = self.trie, self.node, self.ends, self.read
        step, new = trie.setdefault, (len(trie) + 1) << 8
        for at, byte in enumerate(data, at + 1):  # noqa: B007
            node = step(node | byte, new)
            if node == new:  # the phrase was not there
                new += 256
                ends.append(at)
                node = 0
                if new > DICTIONARY << 8:
                    trie.clear()
                    new = 256
        self.node, self.read = node, at
        return self


def phrase_hashes(data: bytes, ends: list[int]) -> Iterator[np.ndarray]:
    """64-bit hashes of the phrases' bytes, in slabs: a polynomial from running sums, mixed."""
    stops = np.array(ends, np.int64)
    starts = np.concatenate(([0], stops[:-1])) if len(stops) else stops
    first = 0
    while first < len(stops):
        last = max(first + 1, int(np.searchsorted(stops, starts[first] + SLAB, "right")))
        a, b = starts[first:last], stops[first:last]
        base = int(a[0])
        piece = np.frombuffer(data, np.uint8, int(b[-1]) - base, base).astype(np.uint64) + np.uint64(1)
        up, down = _powers(len(piece) + 1)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(piece * up[:-1])))
        h = (sums[b - base] - sums[a - base]) * down[a - base]
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        yield h ^ (h >> np.uint64(31))
        first = last


def signature(data: bytes, parse: Parse) -> np.ndarray:
    """One byte per bin: 0 where no phrase falls, else from the smallest hash there."""
    least, used = np.full(BINS, ~np.uint64(0), np.uint64), np.zeros(BINS, bool)
    for h in phrase_hashes(data, parse.ends):
        h.sort()
        bins = (h >> np.uint64(56)).astype(np.int64)
        at = np.flatnonzero(np.diff(bins, prepend=-1))
        own = bins[at]
        least[own] = np.minimum(least[own], h[at])
        used[own] = True
    return np.where(used, 1 + (least & np.uint64(0xFFFFFFFF)) % np.uint64(VALUES), 0).astype(np.uint8)


def fingerprint(text: str | None) -> np.ndarray:
    data = (text or "").encode()
    return signature(data, Parse().feed(data))


def likeness(one: np.ndarray, other: np.ndarray) -> float:
    """0 to 1; 1 for equal fingerprints, also for those of two empty texts."""
    n = int(np.count_nonzero(one | other))
    if not n:
        return 1.0
    both = int(np.count_nonzero((one > 0) & (other > 0)))
    same = int(np.count_nonzero((one == other) & (one > 0)))
    return max(0.0, (same - both / VALUES) / (1 - 1 / VALUES)) / n


def fingerprints(docs: DataFrame, *, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of every whole text as hex text; null texts are empty. A map: nothing is shuffled."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(row, F.col(f"`{text}`").cast("string").alias("text"))
    schema = rows.select("row").schema.add(out, "string")

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [fingerprint(t.as_py()).tobytes().hex() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.string())], ["row", out])

    return rows.mapInArrow(mapped, schema).select("row.*", out)


# -- every document beside its successor ------------------------------------------------------------------------------


class Text:
    """A text, its parse up to the edit, and its fingerprint."""

    def __init__(self, text: str) -> None:
        self.text, self.cut = text, len(text) - len(text) // KEPT
        self.kept = text[:self.cut].encode()
        self.half = Parse().feed(self.kept)
        tail = text[self.cut:].encode()
        whole = self.half.fork().feed(tail) if tail else self.half
        self.fingerprint = signature(self.kept + tail, whole)

    def edited(self, other: str) -> tuple[str, np.ndarray]:
        """SHA-256 and fingerprint of the text with its last part replaced by the beginning of another."""
        tail = other[:len(self.text) - self.cut].encode()
        data = self.kept + tail
        return hashlib.sha256(data).hexdigest(), signature(data, self.half.fork().feed(tail))


Key = tuple[bool, int, int]  # id is known, id, hash of the text: the order of documents
_ROW = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _first_keys(keys: DataFrame, parts: int) -> list[Key]:
    """The first key of each range when all keys are sorted into ``parts`` ranges. One row per range reaches the driver."""
    ranged = keys.repartitionByRange(parts, "known", "id", "tie")
    least = ranged.groupBy(F.spark_partition_id().alias("part")).agg(F.min(F.struct("known", "id", "tie")).alias("key"))
    return sorted(tuple(r["key"]) for r in least.collect())


def edited_neighbours(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_chars`` (code points), ``edited_sha256`` (of the text whose last quarter, rounded
    down, is replaced by the first as many code points of the next document, or all of them), ``fingerprint``,
    ``edited_fingerprint``, ``near_edited`` and ``near_next``: the likeness to the edited text and to the next document.

    Null texts are empty. Documents ascend by id, null ids first, rows of one id by the hash of their texts; the first
    follows the last, and a single document follows itself. Other columns are not read; an empty table gives no rows.

    Texts are shuffled once. Ranges are found from ids and hashes alone; the first document of each range is also
    sent to the range before, so every task has the successor of its last document. Rows that repeat an id
    and a text become one with a count before the shuffle, batch by batch."""
    spark = docs.sparkSession
    content = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    number = F.col(f"`{doc_id}`").cast("long")
    key = [number.isNotNull().alias("known"), F.coalesce(number, F.lit(0)).alias("id"), F.xxhash64(content).alias("tie")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    firsts = _first_keys(docs.select(*key), parts)
    before = {k: (i - 1) % len(firsts) for i, k in enumerate(firsts)}

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            copies: dict[Key, list[int]] = {}
            for i, k in enumerate(zip(*(c.to_pylist() for c in batch.columns[:3]))):
                copies.setdefault(k, [i, 0])[1] += 1
            rows = [(bisect_right(firsts, k) - 1, 0, i, n) for k, (i, n) in copies.items()]
            rows += [(before[k], 1, i, n) for k, (i, n) in copies.items() if k in before]
            if not rows:
                continue
            part, follower, at, n = zip(*rows)
            picked = batch.take(pa.array(at, pa.int64()))
            made = [pa.array(part, pa.int32()), pa.array(follower, pa.int32()), pa.array(n, pa.int64()), *picked.columns]
            yield pa.RecordBatch.from_arrays(made, ["part", "follower", "copies", *batch.schema.names])

    schema = "part int, follower int, copies long, known boolean, id long, tie long, text string"
    order = ["part", "follower", "known", "id", "tie"]
    rows = docs.select(*key, content.alias("text")).mapInArrow(dealt, schema)
    rows = rows.repartitionById(max(1, len(firsts)), "part").sortWithinPartitions(*order)

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        held: tuple | None = None  # key, copies, text

        def pair(last: tuple, own: Text, follower: Text) -> Iterator[pa.RecordBatch]:
            """All copies of a document but the last are followed by a copy."""
            for n, other in ((last[1] - 1, own), (1, follower)):
                if n:
                    digest, edited = own.edited(other.text)
                    near = likeness(own.fingerprint, edited), likeness(own.fingerprint, other.fingerprint)
                    names = own.fingerprint.tobytes().hex(), edited.tobytes().hex()
                    row = (last[0][1] if last[0][0] else None, len(own.text), digest, *names, *near)
                    for _ in range(n):
                        out.append(row)
                        if len(out) >= FLUSH:
                            yield flush()

        def flush() -> pa.RecordBatch:
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            made = [pa.array(c, t) for c, t in zip(zip(*out), types)]
            out.clear()
            return pa.RecordBatch.from_arrays(made, [c.split()[0] for c in _ROW.split(", ")])

        for batch in batches:
            _, follower, copies, known, ids, ties = (c.to_pylist() for c in batch.columns[:6])
            for i, k in enumerate(zip(known, ids, ties)):
                if follower[i]:
                    if held is not None:
                        same = held[0] == k
                        yield from pair(held, held[2], held[2] if same else Text(batch.column(6)[i].as_py()))
                        held = None
                elif held is not None and held[0] == k:
                    held = (k, held[1] + copies[i], held[2])
                else:
                    own = Text(batch.column(6)[i].as_py())
                    if held is not None:
                        yield from pair(held, held[2], own)
                    held = (k, copies[i], own)
        if out:
            yield flush()

    return rows.mapInArrow(compared, _ROW)

"""Benchmark decontamination with suffix arrays of the training text.

Words are the maximal runs of ASCII letters, ASCII digits and non-ASCII characters, A-Z in lower case. Each
Arrow batch of documents is a shard. Its words become numbers, and a suffix array is built by doubling: the
suffixes in the order of their words. Runs of words that are all known to the benchmark are all that can match, so
the array holds just their suffixes; where longest matches are not asked for, a run is at least as long as the
shortest window. Every suffix of every benchmark item is then narrowed down word by word with binary searches.
At every length all places that still match are noted, which leaves each place its longest verbatim match, and, at the
length of a window, all places of that window.

The benchmark is the small, stated side. Tasks number its words and store it in chunks of at most ``CHUNK_WORDS`` words (or one
item). Every task reads the chunks one after another and holds one at a time, so that neither the driver nor a
worker ever has the whole of it; only the names of the chunks reach the driver."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipquarry.llm.common import released, store
from clipquarry.llm.files import create, open_file
from clipquarry.session import scratch_path

WINDOW = 13
SHARE = 20  # a document is contaminated if at least one in so many of its words is hit
CHUNK_WORDS = 4_000_000
BYTES_PER_WORD = 6  # of the benchmark, about: how many tasks pack it
_KEEP = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_TABLE = bytes(
    b if b in _KEEP else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


class ItemChunk:
    """Benchmark items as numbered words, and where their suffixes and windows begin."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int) -> None:
        items = sorted(items)  # so that the first of several suffixes that match alike does not depend on their order
        self.names = [name for name, _ in items]
        self.vocabulary: dict[bytes, int] = {}
        flat, owner, offset, rest, need = [], [], [], [], []
        for k, (_, words) in enumerate(items):
            n, length = len(words), min(window, len(words))
            flat += [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
            owner += [k] * n
            offset += range(n)
            rest += range(n, 0, -1)
            need += [length] * n
        self.words, self.owner = np.array(flat, np.int64), np.array(owner, np.int64)
        self.offset = np.array(offset, np.int64)
        self.rest, self.need = np.array(rest, np.int64), np.array(need, np.int64)
        self.shortest = int(self.need.min()) if flat else 0
        self.longest = int(self.rest.max()) if flat else 0


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Places of all words of ``text`` (0 separates) in the order of the suffixes that begin there, compared
    by at least their first ``depth`` words or up to the next separator."""
    n, done = len(text), 1
    ends = np.flatnonzero(text == 0)
    rest = np.repeat(ends, np.diff(ends, prepend=-1)) - np.arange(n)  # words up to the next separator
    smaller = np.cumsum(np.bincount(text))
    rank = np.where(text > 0, smaller[text - 1], 0)  # how many suffixes come before
    while done < depth and (going := np.flatnonzero(rest > done)).size:
        # only suffixes that go on are ordered anew, behind the equal ones that end here
        key = rank[going] * (n + 1) + rank[going + done]
        order = np.argsort(key, kind="stable")
        going, key = going[order], key[order]
        old = rank[going]
        here, group = np.arange(len(going)), np.flatnonzero(np.diff(old, prepend=-1))
        first = np.maximum.accumulate(np.where(np.diff(key, prepend=-1) != 0, here, 0))
        size = np.diff(group, append=len(going))
        ended = np.bincount(rank, minlength=n + 1)[old[group]] - size
        rank[going] = old + np.repeat(ended - group, size) + first
        done *= 2
    order = np.argsort(rank, kind="stable")
    return order[len(ends):]


def _bound(array: np.ndarray, text: np.ndarray, lo: np.ndarray, hi: np.ndarray, depth: int, word: np.ndarray, right: bool) -> np.ndarray:
    """The first place in [lo, hi) whose word at ``depth`` is not below ``word`` (or is above it)."""
    lo, hi = lo.copy(), hi.copy()
    last = len(text) - 1
    while (open_ := np.flatnonzero(lo < hi)).size:
        mid = (lo[open_] + hi[open_]) >> 1
        at = text[np.minimum(array[mid] + depth, last)]
        below = at <= word[open_] if right else at < word[open_]
        lo[open_[below]] = mid[below] + 1
        hi[open_[~below]] = mid[~below]
    return lo


def search(text: np.ndarray, chunk: ItemChunk, longest: bool) -> tuple[np.ndarray, list[tuple[int, np.ndarray]], np.ndarray]:
    """Of each place of ``text``: the length of the longest match that begins there (0 throughout unless ``longest``) and
    the first item suffix with it; and, for each window that occurs, (suffix, places). ``text`` ends with a separator."""
    run = int(np.diff(np.flatnonzero(text == 0), prepend=-1).max()) - 1
    array = suffix_array(text, min(chunk.longest, run))
    m = len(chunk.words)
    length, source = np.zeros(len(text), np.int64), np.full(len(text), -1, np.int64)
    lo, hi, live = np.zeros(m, np.int64), np.full(m, len(array), np.int64), np.arange(m)
    windows, depth = [], 0
    while live.size:
        word = chunk.words[live + depth]
        a = _bound(array, text, lo, hi, depth, word, False)
        b = _bound(array, text, a, hi, depth, word, True)
        found = a < b
        live, lo, hi, depth = live[found], a[found], b[found], depth + 1
        if longest:
            # intervals of one depth are equal or apart
            begin, first = np.unique(lo, return_index=True)
            size = hi[first] - begin
            at = array[np.arange(size.sum()) + np.repeat(begin - np.cumsum(size) + size, size)]
            length[at], source[at] = depth, np.repeat(live[first], size)
        for i in np.flatnonzero(chunk.need[live] == depth):
            windows.append((int(live[i]), array[lo[i]:hi[i]]))
        more = chunk.rest[live] > depth
        live, lo, hi = live[more], lo[more], hi[more]
    return length, windows, source


def _shard(texts: list[str | None], chunk: ItemChunk, shortest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of words per document; the words of runs that can match and have at least ``shortest`` words, with
    separators; and the place of each of them counted over all words of the shard (-1 at separators)."""
    get, found, counts = chunk.vocabulary.get, [np.zeros(0, np.int64)], []
    for text in texts:
        words = words_of(text)
        counts.append(len(words))
        found += (np.fromiter(map(get, words, repeat(0)), np.int64, len(words)), np.zeros(1, np.int64))
    ids, counts = np.concatenate(found), np.array(counts, np.int64)
    place = np.arange(len(ids)) - np.repeat(np.arange(len(counts)), counts + 1)
    edges = np.flatnonzero(np.diff(np.concatenate(([0], ids > 0, [0])).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    enough = ends - starts >= shortest
    # of each run its words and the separator behind it
    n = len(ids) + 1
    kept = np.cumsum(np.bincount(starts[enough], minlength=n) - np.bincount(ends[enough] + 1, minlength=n))[:-1] > 0
    return counts, ids[kept], np.where(ids > 0, place, -1)[kept]


Match = tuple[int, int, str, int]  # words of a longest match, negative; its start; the item; its start in the item
NO_MATCH: Match = (0, 0, "", 0)


def scan(
    texts: list[str | None], chunks: Iterator[ItemChunk], longest: bool = True
) -> list[tuple[int, list[tuple[int, int]], list[str], Match]]:
    """Of each text: its words, the spans (start, words) that windows cover, the items, and of its longest matches the
    first by start, item and start in the item (``NO_MATCH`` unless ``longest``)."""
    n = len(texts)
    counts, hit, items, best = None, None, [set() for _ in range(n)], [NO_MATCH] * n
    for chunk in chunks:
        counts, text, places = _shard(texts, chunk, 1 if longest else chunk.shortest)
        ends = np.cumsum(counts)
        if hit is None:
            hit = np.zeros(int(ends[-1]) + 1 if n else 1, np.int32)
        if not text.size:
            continue
        length, windows, source = search(text, chunk, longest)
        matched = np.flatnonzero(length)
        owner = np.searchsorted(ends, places[matched], "right")
        order = np.lexsort((matched, -length[matched], owner))  # places of a text ascend in the shard
        for k in order[np.flatnonzero(np.diff(owner[order], prepend=-1))].tolist():
            d, at = int(owner[k]), matched[k]
            suffix, start = source[at], int(places[at] - ends[d] + counts[d])
            name, offset = chunk.names[chunk.owner[suffix]], int(chunk.offset[suffix])
            best[d] = min(best[d], (-int(length[at]), start, name, offset))
        for suffix, at in windows:
            at = places[at]
            np.add.at(hit, at, 1)
            np.add.at(hit, at + chunk.need[suffix], -1)
            name = chunk.names[chunk.owner[suffix]]
            for d in np.unique(np.searchsorted(ends, at, "right")).tolist():
                items[d].add(name)
    if counts is None:
        counts = np.array([len(words_of(t)) for t in texts], np.int64)
        hit = np.zeros(int(counts.sum()) + 1, np.int32)
    covered, out, base = np.cumsum(hit) > 0, [], 0
    for d, n_words in enumerate(counts.tolist()):
        spans = []
        if items[d]:
            own = np.concatenate(([0], covered[base:base + n_words], [0])).astype(np.int8)
            edges = np.flatnonzero(np.diff(own)).tolist()
            spans = [(s, e - s) for s, e in zip(edges[::2], edges[1::2])]
        out.append((n_words, spans, sorted(items[d]), best[d]))
        base += n_words
    return out


def item_chunks(benchmark: DataFrame, *, window: int, item_id: str, text: str, chunk_words: int) -> list[str]:
    """URIs of stored :class:`ItemChunk` objects, each of at most ``chunk_words`` words or one item. Equal rows count once."""
    spark = benchmark.sparkSession
    rows = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("i"), F.col(text).cast("string").alias("t")).distinct()
    size = benchmark.agg(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0
    folder = scratch_path(spark, "benchmark")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def close() -> pa.RecordBatch:
            uri, out = create(folder, ".items")
            with out:
                pickle.dump(ItemChunk(held, window), out, protocol=5)
            return pa.RecordBatch.from_arrays([pa.array([uri])], ["chunk"])

        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(value)
                if held and n + len(words) > chunk_words:
                    yield close()
                    held, n = [], 0
                if words:
                    held.append((name, words))
                    n += len(words)
        if held:
            yield close()

    parts = max(1, -(-size // (BYTES_PER_WORD * chunk_words)))
    found = store(rows.repartition(parts, "i", "t").mapInArrow(packed, "chunk string"), "benchmark_chunks")
    return sorted(r["chunk"] for r in found.collect())


_HELD: dict[str, ItemChunk] = {}  # the chunk that this process read last


def stored_chunk(uri: str) -> ItemChunk:
    if uri not in _HELD:
        _HELD.clear()
        with open_file(uri) as f:
            _HELD[uri] = pickle.loads(f.read())
    return _HELD[uri]


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    window: int = WINDOW,
    share: int = SHARE,
    carry: list[str] | None = None,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    chunk_words: int = CHUNK_WORDS,
    longest: bool = True,
) -> DataFrame:
    """The columns ``carry`` of ``docs`` (default: all) as struct ``row``, with ``n_words``, ``n_hit``, ``spans``
    (``start``, ``words``: the words that windows of ``window`` words cover; an item with fewer is one window),
    ``items`` (ids as sorted strings), ``longest_match`` (words of the longest run that the document shares with an
    item, also one shorter than a window), ``longest_at`` (where: ``start``, ``item`` and ``item_start``, counted in words;
    the first by these of several; null without any) and ``contaminated``: some word is hit and at least one in ``share``.
    Without ``longest`` these two columns are left out.

    Null and empty texts have no words and are never contaminated; neither do items without words match.
    Items with a null id are reported as "". Equal items count once, equal documents are judged alike, an
    empty table on either side gives no hits."""
    chunks = item_chunks(benchmark, window=window, item_id=item_id, text=item_text, chunk_words=chunk_words)
    carry = docs.columns if carry is None else carry
    row = F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row")
    rows = docs.select(row) if text in carry else docs.select(row, F.col(text).alias("text"))
    added = "n_words long, n_hit long, spans array<struct<start:int,words:int>>, items array<string>"
    if longest:
        added += ", longest_match int, longest_at struct<start:int,item:string,item_start:int>"
    schema = T.StructType([rows.schema["row"], *T.DataType.fromDDL(added).fields])
    place = pa.struct([("start", pa.int32()), ("item", pa.string()), ("item_start", pa.int32())])
    span = pa.list_(pa.struct([("start", pa.int32()), ("words", pa.int32())]))

    @released
    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column(0)
            texts = row.flatten()[carry.index(text)] if text in carry else batch.column(1)
            found = scan(texts.to_pylist(), map(stored_chunk, chunks), longest)
            n_words, spans, items, best = zip(*found) if found else ((), (), (), ())
            n_hit = [sum(w for _, w in s) for s in spans]
            listed = [[{"start": a, "words": w} for a, w in s] for s in spans]
            made = {
                "row": row,
                "n_words": pa.array(n_words, pa.int64()),
                "n_hit": pa.array(n_hit, pa.int64()),
                "spans": pa.array(listed, span),
                "items": pa.array(items, pa.list_(pa.string())),
            }
            if longest:
                at = [{"start": s, "item": i, "item_start": o} if n else None for n, s, i, o in best]
                made |= {"longest_match": pa.array([-m[0] for m in best], pa.int32()), "longest_at": pa.array(at, place)}
            yield pa.RecordBatch.from_arrays(list(made.values()), list(made))

    dirty = (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))
    return rows.mapInArrow(judged, schema).withColumn("contaminated", dirty)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that :func:`contamination` does not find contaminated, with their own columns."""
    return contamination(docs, benchmark, longest=False, **options).where(~F.col("contaminated")).select("row.*")

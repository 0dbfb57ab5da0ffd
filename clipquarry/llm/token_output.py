"""Token ids in binary files with a shared zstandard dictionary.

A shard holds one zstandard frame per document, each compressed on its own with a dictionary that was
trained on a bounded sample of serialized id arrays, then an index and a footer:

    frames | index: per document has_id u8, doc_id i64, offset u64, n_tokens u64 | footer
    footer: index offset u64, documents u64, bytes per id u8, SHA-256 of the dictionary, magic

All numbers are little-endian, ids too. One document is read by its index entry and its frame; reading it
needs no other frame. The dictionary is a file beside the shards, named by its hash, which readers compare.

Documents are range-partitioned and sorted by id; rows with one id follow each other in the order of a hash
of their texts, so that one id with a third of all rows is spread over partitions as well. A task cuts its
partition into shards of bounded size. The manifest has one row per shard; running totals over it give
every shard its first document and token."""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clipquarry.llm.common import WORKER_CACHE, released, spread, store
from clipquarry.llm.files import create, open_file, read_range
from clipquarry.session import scratch_path

MAGIC = b"CQTOKEN1"
INDEX = np.dtype([("has_id", "u1"), ("doc_id", "<i8"), ("offset", "<u8"), ("n_tokens", "<u8")])
FOOTER = np.dtype([("index", "<u8"), ("docs", "<u8"), ("width", "u1"), ("dictionary", "S32"), ("magic", "S8")])
SHARD_BYTES = 64 << 20
DICTIONARY_BYTES = 64 << 10
SAMPLE_ROWS = 2_000  # pieces of id arrays that the dictionary is trained on, at most
PIECE_IDS = 4_096  # ids in such a piece, at most
LEVEL = 3

SLICE = 64  # texts whose new words are learned at once
TOGETHER = 512  # words that the library is given as one text
MEMO_CHARACTERS = 32 << 20  # of remembered words, in each half of the memo

_MARKS = ".,!?;:%$*#&"
_LATIN = "\u0180"  # letters below it are parted from the marks behind them as ASCII letters are


class WordEncoder:
    """The ids of whole texts as the library gives them, word by word.

    A vocabulary that drops blanks and never merges across them gives a text the ids of its blank-separated
    words in turn, so each distinct word goes through the library once while it is remembered. Latin letters and
    the marks behind them are separate pieces, and ASCII letters are lower-cased. Where tokens say that they end
    a word, many words go through the library as one text."""

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        probe = lambda t: self.tokenizer.encode(t, add_special_tokens=False).ids
        self.lower = probe("Ab") == probe("ab")
        if probe("ab , \n ab") != probe("ab") + probe(",") + probe("ab") or probe("ab,") != probe("ab") + probe(","):
            raise ValueError(f"{path} does not treat blank-separated words alone")
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool) if suffix else None
        if suffix:
            self.ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self._forget()
        self.older: dict[str, bytes] = {}

    def _forget(self) -> None:
        self.older, self.memo, self.held = getattr(self, "memo", {}), {"": b""}, 0

    def _pack(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{'H' if self.width == 2 else 'I'}", *ids)

    def _ask_together(self, parts: list[str]) -> list[str]:
        """Puts words of letters into the memo from one text of all of them: each ends with a token that ends a word. Words
        of a text with more such tokens than words are given back."""
        if self.ends is None:
            return parts
        left: list[str] = []
        for i in range(0, len(parts), TOGETHER):
            some = parts[i:i + TOGETHER]
            ids = self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids
            data = np.array(ids, f"<u{self.width}")
            stops = np.flatnonzero(self.ends[data]) + 1
            if len(stops) != len(some) or (len(some) and stops[-1] != len(data)):
                left += some
                continue
            data, first = data.tobytes(), 0
            for part, last in zip(some, (stops * self.width).tolist()):
                self.memo[part] = data[first:last]
                first = last
        return left

    def _learn(self, words: set[str]) -> None:
        """Puts words into the memo: from the older half of it, or else from the library."""
        memo, older, plans, letters, other = self.memo, self.older, [], set(), set()
        for word in words:
            if (found := older.get(word)) is not None:
                memo[word] = found
                continue
            core = word.rstrip(_MARKS)
            plain = core.isascii()
            if not core.isalpha() or not (plain or max(core) < _LATIN):
                other.add(word)
                continue
            part = core.lower() if self.lower and plain else core
            if part not in memo:
                if (found := older.get(part)) is not None:
                    memo[part] = found
                else:
                    letters.add(part)
            if part != word:
                marks = word[len(core):]
                plans.append((word, part, marks))
                if marks not in memo:
                    other.add(marks)
        other.update(self._ask_together(list(letters)))
        for part, found in zip(other, self.tokenizer.encode_batch_fast(list(other), add_special_tokens=False)):
            memo[part] = self._pack(found.ids)
        for word, part, marks in plans:
            memo[word] = memo[part] + memo[marks]
        self.held += sum(map(len, words))

    def encode(self, texts: list[str | None], end: bytes) -> list[bytes]:
        """Of each text its serialized ids with the end id behind them. Words of many texts are learned at once."""
        out = []
        for i in range(0, len(texts), SLICE):
            # both are blanks that no piece reaches over
            split = [t.replace("\n", " ").split(" ") if t else [] for t in texts[i:i + SLICE]]
            if len(self.memo) > WORKER_CACHE or self.held > MEMO_CHARACTERS:
                self._forget()  # words that come up again move on from the older half
            self._learn(set().union(*split).difference(self.memo))
            out += [b"".join(map(self.memo.__getitem__, words)) + end for words in split]
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return WordEncoder(path)


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def train_dictionary(docs: DataFrame, path: str, end_id: int, size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary from at most ``SAMPLE_ROWS`` pieces of at most ``PIECE_IDS`` ids. They come from documents
    picked by a hash of id and text and are the ones with the smallest hashes; nothing depends on this
    choice but how well frames compress. With too little to train on, the pieces themselves serve."""
    rows = docs.select(F.xxhash64("_id", "_tie").alias("h"), "_text")
    n = docs.count()
    part = min(1.0, 2.0 * SAMPLE_ROWS / max(n, 1))
    chosen = rows.where(F.pmod("h", F.lit(1 << 20)) < int(part * (1 << 20)) + 1)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        end, step = coder._pack([end_id]), PIECE_IDS * coder.width
        for batch in batches:
            for h, packed in zip(batch.column(0).to_pylist(), coder.encode(batch.column(1).to_pylist(), end)):
                cut = [packed[i:i + step] for i in range(0, len(packed), step)]
                order = [hash((h, i)) for i in range(len(cut))]
                yield pa.RecordBatch.from_arrays([pa.array(order, pa.int64()), pa.array(cut, pa.binary())], ["h", "piece"])

    sample = chosen.mapInArrow(pieces, "h long, piece binary").orderBy("h").limit(SAMPLE_ROWS).collect()
    found = [bytes(r["piece"]) for r in sample]
    if not found:
        return b""
    try:
        return zstandard.train_dictionary(size, found, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(found)[:size]


def write_tokens(
    docs: DataFrame,
    path: str,
    *,
    end_id: int,
    folder: str | None = None,
    shard_bytes: int = SHARD_BYTES,
    doc_id: str = "doc_id",
    text: str = "text",
) -> tuple[DataFrame, str]:
    """Writes the ids of every row of ``docs``, each followed by ``end_id``, in ascending order of id. Returns the
    manifest (``shard``, ``docs``, ``tokens``, ``first_doc``, ``first_token``) and the dictionary's URI.

    Null and empty texts are the end id alone. Null ids come first; repeated ids keep all their rows. Other
    columns are not read. An empty table gives an empty manifest."""
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "tokens")
    rows = docs.select(
        F.col(doc_id).cast("long").alias("_id"), F.xxhash64(text).alias("_tie"), F.col(text).alias("_text")
    )
    trained = train_dictionary(rows, path, end_id)
    digest = hashlib.sha256(trained).digest()
    uri, out = create(folder, f"-{digest.hex()}.dict")
    with out:
        out.write(trained)

    @released
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        end, part = coder._pack([end_id]), TaskContext.get().partitionId()
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(trained))
        shard, stream, name, offset, number, entries = None, None, None, 0, 0, []

        def close() -> pa.RecordBatch:
            index = np.array(entries, INDEX)
            stream.write(index.tobytes())
            stream.write(np.array([(offset, len(index), coder.width, digest, MAGIC)], FOOTER).tobytes())
            stream.close()
            row = [part, number, name, len(index), int(index["n_tokens"].sum())]
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in row], ["part", "number", "shard", "docs", "tokens"])

        for batch in batches:
            ids, packed = batch.column(0).to_pylist(), coder.encode(batch.column(1).to_pylist(), end)
            for i, data in zip(ids, packed):
                if stream is None:
                    name, stream = create(folder, ".tokens")
                    offset, entries = 0, []
                frame = packer.compress(data)
                stream.write(frame)
                entries.append((i is not None, i or 0, offset, len(data) // coder.width))
                offset += len(frame)
                if offset >= shard_bytes:
                    yield close()
                    stream, number = None, number + 1
        if stream is not None:
            yield close()
        coder.older = {}  # the next task starts with the newer half

    ordered = rows.repartitionByRange("_id", "_tie").sortWithinPartitions("_id", "_tie").select("_id", "_text")
    shards = store(
        ordered.mapInArrow(write, "part long, number long, shard string, docs long, tokens long"), "manifest"
    )
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    total = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0)).cast("long")
    manifest = shards.select(
        "shard", "docs", "tokens", total("docs").alias("first_doc"), total("tokens").alias("first_token")
    )
    return store(manifest, "shards"), uri


class Shard:
    """Random access to the documents of one file."""

    def __init__(self, uri: str, dictionary: bytes) -> None:
        self.file = open_file(uri)
        size = self.file.size()
        footer = np.frombuffer(read_range(self.file, size - FOOTER.itemsize, FOOTER.itemsize), FOOTER)[0]
        if footer["magic"] != MAGIC:
            raise ValueError(f"{uri} is not a token shard")
        # numpy drops zero bytes at the end of fixed strings
        if footer["dictionary"].ljust(32, b"\0") != hashlib.sha256(dictionary).digest():
            raise ValueError(f"{uri} was written with another dictionary")
        self.end, self.width, n = int(footer["index"]), int(footer["width"]), int(footer["docs"])
        self.index = np.frombuffer(read_range(self.file, self.end, n * INDEX.itemsize), INDEX)
        self.unpacker = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))

    def frames(self, first: int, last: int) -> Iterator[np.ndarray]:
        """The ids of documents ``first`` to ``last`` - 1, from one range of the file."""
        if first >= last:
            return
        starts = [*self.index["offset"][first:last].tolist()]
        stop = int(self.index["offset"][last]) if last < len(self.index) else self.end
        data = memoryview(read_range(self.file, starts[0], stop - starts[0]))
        for a, b in zip(starts, [*starts[1:], stop]):
            packed = self.unpacker.decompress(data[a - starts[0]:b - starts[0]])
            yield np.frombuffer(packed, f"<u{self.width}")

    def document(self, k: int) -> np.ndarray:
        return next(self.frames(k, k + 1))


def read_dictionary(uri: str) -> bytes:
    with open_file(uri) as f:
        return f.read()


def read_tokens(manifest: DataFrame, dictionary_uri: str, *, step: int = 512) -> DataFrame:
    """One row per document from the files: ``doc_id``, ``start`` (tokens of all documents before it),
    ``n_tokens`` and ``ids`` (serialized as little-endian unsigned 32-bit integers)."""

    @released
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dictionary = None
        for batch in batches:
            for uri, token in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                dictionary = read_dictionary(dictionary_uri) if dictionary is None else dictionary
                shard = Shard(uri, dictionary)
                counts = shard.index["n_tokens"].astype(np.int64)
                starts = token + np.cumsum(counts) - counts
                for a in range(0, len(counts), step):
                    b = min(a + step, len(counts))
                    own = shard.index[a:b]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(own["doc_id"].astype(np.int64), mask=own["has_id"] == 0),
                            pa.array(starts[a:b]),
                            pa.array(counts[a:b]),
                            pa.array([x.astype("<u4").tobytes() for x in shard.frames(a, b)], pa.binary()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids"],
                    )

    files = manifest.select("shard", "first_token")
    return spread(files, "shard").mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def round_trip(docs: DataFrame, path: str, *, end_id: int, **options) -> DataFrame:
    """:func:`write_tokens`, then :func:`read_tokens` of what was written."""
    return read_tokens(*write_tokens(docs, path, end_id=end_id, **options))

"""Token counts by merging byte pairs, without emitting identifiers.

A piece of text starts as its bytes, one symbol each. The adjacent pairs that the vocabulary merges stand
in a heap by rank and place; the lowest is popped again and again and joined in a linked list of symbols.
The count is the number of bytes less the number of merges. Texts are cut as byte-level vocabularies cut
them, and each distinct piece is merged once per Python process while it is remembered."""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipquarry.llm.common import WORKER_CACHE

LIMIT = 1024
# The blanks and the pattern of byte-level vocabularies.
BLANK = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECE = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{BLANK}\p{{L}}\p{{N}}]+|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+"
CHUNK = re.compile(f" ?[^{BLANK}]+|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 characters
    stand for themselves, the others for the letters from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(others)) for b in range(256)]


class PairMerger:
    """Counts the tokens of a ``tokenizers`` file of kind byte-level BPE."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        cutter, model = spec["pre_tokenizer"], spec["model"]
        known = spec["normalizer"] is None and cutter["type"] == "ByteLevel" and cutter["use_regex"]
        if not known or cutter["add_prefix_space"] or model["type"] != "BPE" or model.get("ignore_merges"):
            raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
        symbols: dict[str, int] = {letter: b for b, letter in enumerate(byte_letters())}
        self.merges: dict[int, tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            new = symbols.setdefault(left + right, len(symbols))
            pair = symbols.setdefault(left, len(symbols)) << 32 | symbols.setdefault(right, len(symbols))
            self.merges.setdefault(pair, (rank, new))
        specials = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, specials))) if specials else None
        self.pieces = regex.compile(PIECE)
        self.memo: dict[str, int] = {}

    def merged(self, piece: bytes) -> int:
        """The number of symbols left of one piece."""
        find, symbols, n = self.merges.get, list(piece), len(piece)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []
        for i in range(n - 1):
            if found := find(symbols[i] << 32 | symbols[i + 1]):
                heap.append((found[0], i, symbols[i], symbols[i + 1], found[1]))
        heapq.heapify(heap)
        count = n
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = right[i]
            if symbols[i] != a or j >= n or symbols[j] != b:
                continue  # one of the two has been merged since
            symbols[i], symbols[j] = new, -1
            k = right[i] = right[j]
            count -= 1
            if k < n:
                left[k] = i
                if found := find(new << 32 | symbols[k]):
                    heapq.heappush(heap, (found[0], i, new, symbols[k], found[1]))
            if (h := left[i]) >= 0 and (found := find(symbols[h] << 32 | new)):
                heapq.heappush(heap, (found[0], h, symbols[h], new, found[1]))
        return count

    def _chunk(self, chunk: str) -> int:
        total = 0
        for piece in self.pieces.findall(chunk):
            n = self.memo.get(piece)
            if n is None:
                n = self.memo[piece] = self.merged(piece.encode())
            total += n
        return total

    def count(self, text: str) -> int:
        """The tokens of a text; special strings count as one each, as the library has it by default."""
        if self.special is None:
            return self._plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self._plain, parts))

    def _plain(self, text: str) -> int:
        chunks, memo = CHUNK.findall(text), self.memo
        try:
            return sum(map(memo.__getitem__, chunks))
        except KeyError:
            if len(memo) > WORKER_CACHE:
                memo.clear()
            for chunk in set(chunks).difference(memo):
                memo[chunk] = self._chunk(chunk)
            return sum(map(memo.__getitem__, chunks))


@lru_cache(maxsize=2)
def load(path: str) -> PairMerger:
    return PairMerger(path)


def count_tokens(
    docs: DataFrame, path: str, *, limit: int = LIMIT, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit`` (more than ``limit`` tokens) per row. Null
    texts count as empty ones: 0 bytes, 0 tokens. Null and repeated ids stay as they are, other columns
    are not read, and an empty table gives an empty one. ``path`` must exist on every executor."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = load(path)
        for batch in batches:
            n = [merger.count(t) if t else 0 for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n, pa.int64())], names)

    names = ["doc_id", "n_bytes", "n_tokens"]
    n_bytes = F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), n_bytes.alias("n_bytes"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long"
    return rows.mapInArrow(counted, schema).withColumn("over_limit", F.col("n_tokens") > limit)

"""Token counts and token files against the library."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from clipquarry.llm import token_counts, token_output
from clipquarry.llm.queries import QUERIES
from clipquarry.llm.token_output import Shard, WordEncoder, read_dictionary, read_tokens, write_tokens

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
SF_DIR = "/root/testdata/sf0.001"
ODD = [
    "", " ", "\n\n", "a", "don't WON'T  it's", "x  y\n z\t\t", "naïve Éa é  b", "12345 6,7", "<|endoftext|>",
    "a<|endoftext|>b <|startoftext|>c", "ΣΑΣ İx ß", "日本語 テキスト", "a\x1cb \x85c", "!!! a.b. c!?", "  lead", "trail  ",
    "Émile, ÄÖÜ! ǅ. ŉ, Ŀ İs, ſt. ẞ. Ñandú;", "e\u0301a, É\u0301. ª º.",
    "x" * 3000, "the " * 2000, "ab." * 500, "​　x", "🙂👍🏽 ok", "'s 't 'LL", "a|b <|x|>",
]
ALPHABET = st.sampled_from(list("abcAB'st.,!19 \n\té́ß Σ<|>endoftxr \x1c日🙂"))


@pytest.fixture(scope="module")
def merger():
    return token_counts.PairMerger(BYTES)


@pytest.fixture(scope="module")
def libraries():
    return Tokenizer.from_file(BYTES), Tokenizer.from_file(WORDS), WordEncoder(WORDS)


@settings(max_examples=400, deadline=None)
@given(st.text(ALPHABET, max_size=40) | st.text(max_size=30).filter(lambda t: t.isprintable()))
def test_any_text(merger, libraries, text):
    whole, words, coder = libraries
    assert merger.count(text) == len(whole.encode(text, add_special_tokens=False).ids)
    assert np.frombuffer(coder.encode([text], b"")[0], "<u2").tolist() == words.encode(text, add_special_tokens=False).ids


def test_odd_texts(merger, libraries):
    whole, words, coder = libraries
    for text in ODD:
        assert merger.count(text) == len(whole.encode(text, add_special_tokens=False).ids), text
        assert np.frombuffer(coder.encode([text], b"")[0], "<u2").tolist() == words.encode(text, add_special_tokens=False).ids, text


def test_op9_against_library(spark, libraries):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    want = {r["doc_id"]: len(libraries[0].encode(r["text"] or "", add_special_tokens=False).ids) for r in docs}
    rows = QUERIES["op9_token_counts"](spark, SF_DIR).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == want
    assert all(r["over_limit"] == (r["n_tokens"] > 1024) for r in rows)
    assert {r["doc_id"]: r["n_bytes"] for r in rows} == {r["doc_id"]: len((r["text"] or "").encode()) for r in docs}


def _expected(rows, tokenizer):
    out, start = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_op5_against_library(spark, libraries):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    rows = QUERIES["op5_token_output"](spark, SF_DIR).collect()
    assert sorted(map(tuple, rows)) == _expected(docs, libraries[1])


SCHEMA = "doc_id long, text string, ids string, _tie int, _text string"


def test_token_files_of_odd_rows(spark, libraries):
    rows = [(None, "x y", "a", 1, "b"), (3, None, None, None, None), (3, "", "", 2, ""), (1, ODD[16] * 30, "q", 3, "c")]
    rows += [(7, "same text here", "z", 1, "z")] * 50 + [(-5, "Die Häuser, the end.", "z", 1, "z")]
    docs = spark.createDataFrame(rows, SCHEMA)
    manifest, uri = write_tokens(docs, WORDS, end_id=1, shard_bytes=200)
    got = [(r["doc_id"], r["start"], r["n_tokens"], zlib.crc32(r["ids"])) for r in read_tokens(manifest, uri).collect()]
    want = _expected([r[:2] for r in rows], libraries[1])
    assert sorted(x[1] for x in got) == sorted(x[1] for x in want)
    assert sorted(map(str, ((x[0], *x[2:]) for x in got))) == sorted(map(str, ((x[0], *x[2:]) for x in want)))
    shards = manifest.orderBy("first_doc").collect()
    assert len(shards) > 1 and sum(s["docs"] for s in shards) == len(rows)
    dictionary = read_dictionary(uri)
    last = Shard(shards[-1]["shard"], dictionary)
    assert last.document(len(last.index) - 1).tolist()[-1] == 1
    with pytest.raises(ValueError, match="another dictionary"):
        Shard(shards[-1]["shard"], dictionary + b"x")


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert token_output.round_trip(empty, WORDS, end_id=1).count() == 0
    assert token_counts.count_tokens(empty, BYTES).count() == 0


def test_counts_of_odd_rows(spark, libraries):
    rows = [(None, "x y", "a", 1, "b"), (3, None, None, None, None), (3, "", "", 2, "")]
    rows += [(i, t, "", i, "") for i, t in enumerate(ODD)] + [(9, "the end", "", 1, "")] * 3
    got = token_counts.count_tokens(spark.createDataFrame(rows, SCHEMA), BYTES, limit=10).collect()
    want = [(r[0], len((r[1] or "").encode()), len(libraries[0].encode(r[1] or "", add_special_tokens=False).ids)) for r in rows]
    assert sorted(map(str, (tuple(r)[:3] for r in got))) == sorted(map(str, want))
    assert all(r["over_limit"] == (r["n_tokens"] > 10) for r in got)

"""Mixing, decontamination, top-k and WARC packages on odd rows, against brute force."""

import gzip
import hashlib
import json
import io
import math
import random
import zipfile
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clipquarry.llm import decontaminate, mixing, topk, warc_zip
from clipquarry.llm.files import create, open_file, read_range

# --- mixing ------------------------------------------------------------------------------------------

DOCS = "doc_id long, text string, source string, copy int, shuffle_key string, parts int"


def test_counts_follow_the_rates(spark):
    rows = [(i, "x" * 100, "big" if i % 10 else "small", i, "k", 0) for i in range(4_000)]
    weights = spark.createDataFrame([("big", 1.0), ("small", 0.5), ("small", 0.5), ("gone", 3.0)], "source string, weight double")
    out = mixing.poisson_mix(spark.createDataFrame(rows, DOCS), weights)
    n = Counter(r["source"] for r in out.collect())
    for s in ("big", "small"):
        assert abs(n[s] - 2_000) < 5 * math.sqrt(2_000)
    copies = Counter(r["doc_id"] for r in out.where("source = 'small'").collect())
    assert max(copies.values()) > 8 and len(copies) > 380
    assert out.columns == [*DOCS.replace(",", "").split()[::2], "_copy", "_shuffle_key"]


def test_large_rates_and_zero_weights(spark):
    rows = [(1, "abc", "a", 0, "", 0), (2, "abc", "b", 0, "", 0), (3, "", "c", 0, "", 0), (4, None, None, 0, "", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    weights = spark.createDataFrame([("a", 1.0), ("b", 0.0), ("c", 9.0)], "source string, weight double")
    n = Counter(r["doc_id"] for r in mixing.poisson_mix(docs, weights, total=6_000).collect())
    assert set(n) == {1} and abs(n[1] - 2_000) < 250


def test_mixing_is_repeatable_with_odd_rows(spark):
    rows = [(None, "same", None, 1, "", 0)] * 30 + [(5, None, "s", 1, "", 0), (5, "", "s", 1, "", 0), (6, "y" * 90_000, "s", 1, "", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    a = mixing.poisson_mix(docs, total=400_000)
    assert sorted(map(str, a.collect())) == sorted(map(str, mixing.poisson_mix(docs.repartition(3), total=400_000).collect()))
    assert {r["count"] for r in a.where("doc_id IS NULL").groupBy("_copy").count().collect()} in ({30}, set())
    assert mixing.poisson_mix(docs.where("false")).count() == 0
    plan = a._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# --- decontamination -----------------------------------------------------------------------------------


def slow_words(text):
    out, word = [], ""
    for c in text or "":
        c = c.lower() if "A" <= c <= "Z" else c
        if c.isascii() and not (c.isdigit() or "a" <= c <= "z"):
            out, word = out + [word] if word else out, ""
        else:
            word += c
    return out + [word] if word else out


def slow_judge(text, items, window):
    words = slow_words(text)
    hit, found = set(), set()
    for name, item in items:
        own = slow_words(item)
        n = min(window, len(own))
        grams = {tuple(own[i:i + n]) for i in range(len(own) - n + 1)} if n else set()
        for i in range(len(words) - n + 1):
            if n and tuple(words[i:i + n]) in grams:
                hit |= set(range(i, i + n))
                found.add(name)
    longest = 0
    for _, item in items:
        own = slow_words(item)
        for i in range(len(own)):
            for j in range(len(words)):
                n = 0
                while i + n < len(own) and j + n < len(words) and own[i + n] == words[j + n]:
                    n += 1
                longest = max(longest, n)
    return len(words), len(hit), sorted(found), longest


@pytest.mark.parametrize("window, alphabet, chunk", [(3, 3, 4_000_000), (4, 6, 40), (13, 40, 200), (2, 2, 1)])
def test_hits_against_brute_force(spark, window, alphabet, chunk):
    rng = random.Random(window)
    text = lambda n: " ".join(rng.choice("abcdefghijklmnopqrstuvwxyzäöüßéABCDEFGHIJ"[:alphabet]) for _ in range(n))
    items = [(str(i), text(rng.choice([0, 1, 2, 5, 20]))) for i in range(8)] + [("3", text(9)), ("", text(7)), ("7", None)]
    docs = [(i, text(rng.randrange(60))) for i in range(60)] + [(None, None), (7, ""), (7, "--"), (8, items[4][1] + "; " + text(5))]
    docs += [(9, f"{text(3)}-{items[5][1]}.{items[9][1]}!")] * 3
    d = spark.createDataFrame([(i, t, "r", 1) for i, t in docs], "doc_id long, text string, row string, n_hit int")
    b = spark.createDataFrame([(i or None, t) for i, t in items], "item_id string, text string")
    out = decontaminate.contamination(d, b, window=window, chunk_words=chunk).collect()
    got = sorted(str((r["row"]["doc_id"], r["row"]["text"], r["n_words"], r["n_hit"], r["items"])) for r in out)
    assert got == sorted(str((i, t, *slow_judge(t, items, window)[:3])) for i, t in docs)
    for r in out:
        n_words, n_hit, _, longest = slow_judge(r["row"]["text"], items, window)
        assert r["longest_match"] <= longest and sum(s["words"] for s in r["spans"]) == n_hit
        assert r["contaminated"] == (n_hit > 0 and 20 * n_hit >= n_words)
    left = decontaminate.remove_contaminated(d, b, window=window)
    assert left.columns == d.columns and left.count() == sum(not r["contaminated"] for r in out)


def slow_longest(text, items):
    """The longest run shared with an item: its words, start, item and start in the item; the first of several."""
    words, best = slow_words(text), (0, 0, "", 0)
    for name, item in items:
        own = slow_words(item)
        for i in range(len(own)):
            for j in range(len(words)):
                n = 0
                while i + n < len(own) and j + n < len(words) and own[i + n] == words[j + n]:
                    n += 1
                best = min(best, (-n, j, name, i) if n else best)
    return best


@pytest.mark.parametrize("batch, chunk", [(10_000, 4_000_000), (3, 4_000_000), (7, 30)])
def test_longest_matches_and_their_places(spark, batch, chunk):
    """Of every copy and of documents with the same passage, in one batch and in several."""
    rng = random.Random(11)
    text = lambda n, m=30: " ".join(f"w{rng.randrange(m)}" for _ in range(n))
    items = [(f"i{k}", text(n)) for k, n in enumerate([25, 14, 20, 3, 1, 25])]
    passage = " ".join(items[0][1].split()[4:20])
    docs = [passage, f"new {passage} more", f"{text(4)} x {passage}"] * 4 + [" ".join(passage.split()[:9]) + " y"] * 5
    docs += [text(rng.randrange(40), 60) for _ in range(40)] + [None, "", "no known word", items[1][1], "w1 z w2 z"]
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").coalesce(1)
    b = spark.createDataFrame(items, "item_id string, text string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        out = decontaminate.contamination(d, b, chunk_words=chunk).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for r in out:
        n, start, item, item_start = slow_longest(r["row"]["text"], items)
        assert (r["longest_match"], r["longest_at"]) == (-n, (start, item, item_start) if n else None)


def test_empty_sides_of_decontamination(spark):
    d = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    b = spark.createDataFrame([("x", "a b c")], "item_id string, text string")
    assert [r["n_words"] for r in decontaminate.contamination(d, b.where("false")).collect()] == [3]
    assert decontaminate.contamination(d.where("false"), b).count() == 0


def test_suffix_array_orders_suffixes():
    rng = np.random.default_rng(3)
    text = np.concatenate([np.append(rng.integers(1, 4, rng.integers(1, 30)), 0) for _ in range(20)])
    array = decontaminate.suffix_array(text, 32)
    words = lambda i: tuple(text[i:i + text[i:].tolist().index(0)])
    assert sorted(array.tolist()) == np.flatnonzero(text).tolist()
    assert [words(i) for i in array] == sorted(words(i) for i in array)


# --- top-k ---------------------------------------------------------------------------------------------


def slow_top(vectors, queries, k):
    """Every row is a candidate of its own; rows of one query id put what they find together."""
    fit = lambda v: v is not None and all(x is not None and math.isfinite(x) for x in v)
    whole = lambda v: [math.floor(64 * x) for x in v]
    found = {}
    for q, qv in queries:
        if q is not None and fit(qv):
            found.setdefault(q, []).extend(
                (-sum(a * b for a, b in zip(whole(qv), whole(v))), i)
                for i, v in vectors if i is not None and fit(v) and i != q and len(v) == len(qv)
            )
    return sorted((q, r, i, -s) for q, scores in found.items() for r, (s, i) in enumerate(sorted(scores)[:k], 1))


def test_repeated_rows_are_candidates(spark):
    vectors = [(7, [1.0, 1.0])] * 30 + [(8, [0.5, x]) for x in (0.5, 0.25, 0.5)] + [(20, [1.0, 0.5]), (40, [0.5, 1.0]), (40, [1.0, 1.0])]
    vectors += [(100 + i, [0.125, 0.125]) for i in range(38) if (100 + i) % 20] + [(60, [1.0, 1.0])] * 3
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(4)
    for k, block in ((20, 16_384), (35, 9), (200, 5)):
        got = topk.exact_top_k(df, df.where("vec_id % 20 = 0"), k=k, block_rows=block, chunk_rows=2)
        assert sorted(map(tuple, got.collect())) == slow_top(vectors, [v for v in vectors if v[0] % 20 == 0], k)


@pytest.mark.parametrize("block, chunk, dims", [(16_384, 512, 8), (7, 3, 3), (32, 1, 1)])
def test_top_k_against_all_pairs(spark, block, chunk, dims):
    rng = np.random.default_rng(dims)
    vectors = [(i, (rng.normal(size=dims) * 0.3).tolist()) for i in range(200)]
    vectors += [(i, [0.5] * dims) for i in range(200, 240)] + [(i, [0.0] * dims) for i in range(240, 262)]
    vectors += [(300, None), (None, [1.0] * dims), (301, [None] * dims), (302, [float("nan")] * dims), (303, [float("inf")] * dims)]
    vectors += [(304, [1.0] * (dims + 1)), (305, [2.0] * (dims + 1)), (320, []), (340, []), (1, vectors[1][1])]
    df = spark.createDataFrame([(i, v, 0) for i, v in vectors], "vec_id long, embedding array<double>, score int").repartition(3)
    got = topk.exact_top_k(df, df.where("vec_id % 20 = 0"), k=5, block_rows=block, chunk_rows=chunk)
    want = slow_top(vectors, [v for v in vectors if v[0] is not None and v[0] % 20 == 0], 5)
    assert sorted(map(tuple, got.collect())) == want
    assert topk.exact_top_k(df.where("false"), df.where("false")).count() == 0


def test_numbers_beyond_doubles(spark):
    big = [(0, [3e8, 1.0]), (1, [3e8, 1.0]), (2, [3e8 - 1, 2.0]), (3, [-1e300, 5.0]), (4, [1e300, 5.0])]
    df = spark.createDataFrame(big, "vec_id long, embedding array<double>")
    got = {(r["vec_id"]): r["score"] for r in topk.exact_top_k(df, df.where("vec_id = 0"), k=5).collect()}
    want = {i: sum(math.floor(64 * a) * math.floor(64 * b) for a, b in zip(big[0][1], v)) for i, v in big[1:]}
    assert got == {i: max(min(s, (1 << 63) - 1), -(1 << 63)) for i, s in want.items()}


def test_search_stops_early():
    rng = np.random.default_rng(0)
    values = np.floor(rng.normal(size=(20_000, 2)) * 640)
    lists, scored, listed = np.argsort(-values, axis=0, kind="stable").T.astype(np.int32), [], []

    class Counting(np.ndarray):
        log: list

        def __getitem__(self, k):
            found = np.asarray(self).__getitem__(k)
            self.log.append(found.size)
            return found

    def counting(array, log):
        out = array.view(Counting)
        out.log = log
        return out

    rows, _, read = topk.threshold_search(np.arange(20_000), counting(values, scored), counting(lists, listed), 0, values[0], 5)
    assert sorted((values @ values[0])[rows]) == sorted(np.delete(values @ values[0], 0))[-5:]
    assert sum(scored) < 10_000 and read <= sum(listed) < 10_000  # of 40,000 components and 40,000 list entries


# --- WARC packages ---------------------------------------------------------------------------------------

PAGES = "page_id long, url string, html string, payload string, digest int"


def test_packages_round_trip(spark):
    long = "<p>" + "é" * 100_000
    rows = [(i, f"http://h/{i}", f"<p>{i}" * 60, "c", 1) for i in range(30)]
    rows += [(i, "http://same/ü x", "s" * 100, "c", 1) for i in range(100, 140)] + [(i, "u", "s" * 99, "c", 1) for i in range(200, 205)]
    rows += [(None, None, None, None, None), (None, "n", "s" * 100, "", 1), (50, "a", long, "", 1), (49, "b", long, "", 1), (49, "b", long, "", 1), (51, None, "", "", 1)]
    pages = spark.createDataFrame(rows, PAGES)
    manifest = warc_zip.write_packages(pages.repartition(4), package_bytes=2_000)
    assert manifest.count() > 4 and manifest.agg(F.sum("records")).first()[0] == len(rows)
    got = Counter(
        (r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
        for r in warc_zip.read_packages(manifest).collect()
    )
    want = Counter()
    for i, _, html, *_ in rows:
        data = (html or "").encode()
        same = [r[0] for r in rows if (r[2] or "") == (html or "") and r[0] is not None]
        again = len(data) >= 100 and same and i != min(same)
        want[i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", min(same) if again else None] += 1
    assert got == want
    assert warc_zip.read_packages(warc_zip.write_packages(pages.where("false"))).count() == 0


def test_packages_are_plain_zip_and_gzip(spark):
    pages = spark.createDataFrame([(1, "http://a/b c", "x" * 500, "", 1), (2, "http://b", "x" * 500, "", 1)], PAGES).coalesce(1)
    (row,) = warc_zip.write_packages(pages).collect()
    with open_file(row["package"]) as f:
        data, members, index = f.read(), warc_zip.directory(f), warc_zip.read_index(f)
        start = members[warc_zip.ARCHIVE][0]
        records = [warc_zip.parse_record(read_range(f, start + x["offset"], x["length"])) for x in index]
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        assert z.testzip() is None and z.namelist() == [warc_zip.ARCHIVE, warc_zip.LISTING]
        archive = z.read(warc_zip.ARCHIVE)
    assert gzip.decompress(archive).count(b"WARC/1.1\r\n") == 2
    assert [(r["type"], r["length"], len(r["payload"]), r["refers_to"]) for r in records] == [("response", 500, 500, None), ("revisit", 500, 0, 1)]
    assert index[0]["url"] == "http://a/b c" and records[0]["url"] == "http://a/b%20c"


@pytest.mark.parametrize("zip64", [False, True])
def test_directories_of_packages(tmp_path, zip64):
    uri, out = create(f"file://{tmp_path}/p", ".zip")
    with out:
        writer = warc_zip.PackageWriter(out, zip64)
        for name, data in (("a", b"first"), ("ä/b", b"PK\x05\x06" + b"second" * 9)):
            writer.begin(name)
            writer.add(data[:3])
            writer.add(data[3:])
            writer.end()
        writer.close()
    with open_file(uri) as f:
        members = warc_zip.directory(f)
        assert read_range(f, *members["ä/b"][:2]) == b"PK\x05\x06" + b"second" * 9
        assert read_range(f, *members["a"][:2]) == b"first"
        raw = read_range(f, 0, f.size())
        with pytest.raises(ValueError, match="ends after"):
            read_range(f, f.size() - 2, 5)
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        assert z.testzip() is None and z.read("a") == b"first"
    other = tmp_path / "other.zip"
    with zipfile.ZipFile(other, "w", zipfile.ZIP_STORED) as z:
        z.writestr("m", b"by another writer")
        z.comment = b"a comment"
    with open_file(str(other)) as f:
        assert read_range(f, *warc_zip.directory(f)["m"][:2]) == b"by another writer"
    (tmp_path / "cut.zip").write_bytes(raw[:-30])
    with open_file(str(tmp_path / "cut.zip")) as f, pytest.raises(ValueError):
        warc_zip.directory(f)
    with zipfile.ZipFile(tmp_path / "packed.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("m", b"x" * 100)
    with open_file(str(tmp_path / "packed.zip")) as f, pytest.raises(ValueError, match="compressed"):
        warc_zip.directory(f)


def test_packages_of_several_archives(spark, tmp_path):
    """Another writer: two archives, three indexes (one gzip'd, one out of order), compressed and foreign members beside them."""
    def member(page, text, digest=True):
        body = b"HTTP/1.1 200 OK\r\nX: y\r\n\r\n" + text
        head = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{page}>\r\nWARC-Target-URI: http://x/{page}\r\n"
        head += f"WARC-Payload-Digest: sha256:{hashlib.sha256(text).hexdigest()}\r\n" if digest else ""
        return gzip.compress(head.encode() + f"Content-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n")

    texts = {1: b"one", 2: b"two" * 90, 3: b"", "uuid-x": b"four"}
    records = {k: member(k, t, k != 2) for k, t in texts.items()}
    line = lambda k, name, at: f'x,y)/ 2020 {json.dumps({"url": f"u{k}", "filename": name, "offset": str(at), "length": str(len(records[k]))})}\n'.encode()
    with zipfile.ZipFile(tmp_path / "p.zip", "w", zipfile.ZIP_STORED) as z:
        z.writestr("archive/a.warc.gz", records[1] + records[2])
        z.writestr("datapackage.json", "{}" * 500, zipfile.ZIP_DEFLATED)
        z.writestr("archive/b.warc.gz", b"gap" + records[3] + records["uuid-x"])
        z.writestr("indexes/1.cdxj", line(2, "a.warc.gz", len(records[1])) + line(1, "a.warc.gz", 0))
        z.writestr("indexes/2.cdx.gz", gzip.compress(line("uuid-x", "b.warc.gz", 3 + len(records[3]))))
        z.writestr("indexes/3.cdxj", line(3, "b.warc.gz", 3))
    manifest = spark.createDataFrame([(str(tmp_path / "p.zip"), 4)], "package string, records long")
    got = {(r["page_id"], r["url"], r["payload_digest"], r["payload_bytes"]) for r in warc_zip.read_packages(manifest).collect()}
    want = {(k if isinstance(k, int) else None, f"u{k}", hashlib.sha256(t).hexdigest(), len(t)) for k, t in texts.items()}
    assert got == want
    with zipfile.ZipFile(tmp_path / "q.zip", "w", zipfile.ZIP_STORED) as z:
        z.writestr("indexes/1.cdxj", line(2, "gone.warc.gz", 0))
    with pytest.raises(Exception, match="not in the package"):
        warc_zip.read_packages(spark.createDataFrame([(str(tmp_path / "q.zip"), 1)], "package string, records long")).collect()

"""Phrase fingerprints, resampling and the Merkle manifest against plain versions."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from clipquarry.llm import importance, merkle, phrases
from clipquarry.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, part int, tree string, row string"


def frame(spark, rows):
    """Rows of (doc_id, text, source) with other columns, some of whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, None, s, None, 1, "x", "y") for i, t, s in rows], SCHEMA)


ODD = [
    (None, "no id", "a"), (3, None, "a"), (3, "", "a"), (3, "same id, other text", None), (-7, "Ünï cödé 日本 🙂🙂", "ü"),
    (9, "word " * 3_000, "A"), (10, "x" * 5_000, "A"), (11, "ab", ""), (12, "one two three four", "a"),
    *[(5, "a repeated row of some length", "a")] * 40, (2**62, "far", "b"), (-(2**62), "further", "b"),
]


# -- phrases ----------------------------------------------------------------------------------------------------------


def slow_phrases(data: bytes, most: int = 1 << 20) -> set[bytes]:
    found, book, start = set(), set(), 0
    for end in range(1, len(data) + 1):
        piece = data[start:end]
        if piece not in book:
            book.add(piece)
            found.add(piece)
            start = end
            if len(book) >= most:
                book.clear()
    return found


def slow_print(text: str) -> bytes:
    mask, bins = (1 << 64) - 1, {}
    for piece in slow_phrases(text.encode()):
        h = sum((b + 1) * pow(phrases._BASE, k, 1 << 64) for k, b in enumerate(piece)) & mask
        h = ((h ^ h >> 30) * 0xBF58476D1CE4E5B9) & mask
        h = ((h ^ h >> 27) * 0x94D049BB133111EB) & mask
        h ^= h >> 31
        bins[h >> 56] = min(bins.get(h >> 56, mask), h)
    return bytes(1 + (bins[b] & 0xFFFFFFFF) % 255 if b in bins else 0 for b in range(256))


def slow_near(a: bytes, b: bytes) -> float:
    used = sum(x or y for x, y in zip(map(bool, a), map(bool, b)))
    both, same = sum(bool(x and y) for x, y in zip(a, b)), sum(bool(x and x == y) for x, y in zip(a, b))
    return max(0.0, (same - both / 255) / (1 - 1 / 255)) / used if used else 1.0


def slow_neighbours(rows):
    """Of (id, text) in order: the contract's columns."""
    out = []
    for k, (i, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        q = len(text) // 4
        edited = text[:len(text) - q] + following[:q]
        own, other, after = slow_print(text), slow_print(edited), slow_print(following)
        digest = hashlib.sha256(edited.encode()).hexdigest()
        out.append((i, len(text), digest, own.hex(), other.hex(), slow_near(own, other), slow_near(own, after)))
    return out


def test_op11_against_plain_version(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    want = slow_neighbours(sorted((r["doc_id"], r["text"] or "") for r in docs))
    rows = sorted(map(tuple, QUERIES["op11_phrase_fingerprint"](spark, SF_DIR).collect()))
    assert [r[:5] for r in rows] == [w[:5] for w in want]
    assert np.allclose([r[5:] for r in rows], [w[5:] for w in want], atol=1e-12)
    apart = [r[5] > r[6] for r in rows if r[1] > 50]
    assert np.mean(apart) > 0.98  # an edited text is nearer than the next one


def test_neighbours_of_odd_rows(spark):
    docs = frame(spark, ODD).repartition(7)
    tie = {r["text"]: r["h"] for r in docs.select(F.coalesce("text", F.lit("")).alias("text"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    order = sorted(((i, t or "") for i, t, _ in ODD), key=lambda r: (r[0] is not None, r[0] or 0, tie[r[1]]))
    got = [tuple(r)[:5] for r in phrases.edited_neighbours(docs).collect()]
    assert Counter(got) == Counter(w[:5] for w in slow_neighbours(order))


def test_single_and_empty_tables(spark):
    one = phrases.edited_neighbours(frame(spark, [(1, "only one text", "a")])).collect()
    assert [tuple(r)[:5] for r in one] == [w[:5] for w in slow_neighbours([(1, "only one text")])]
    assert one[0]["near_next"] == 1.0
    none = frame(spark, [])
    assert phrases.edited_neighbours(none).count() == 0 and phrases.fingerprints(none).count() == 0
    assert importance.resample(none, none).count() == 0
    assert merkle.prove(merkle.build(merkle.leaves(none))).count() == 0


def test_fingerprints_are_a_map_that_keeps_columns(spark):
    rows = phrases.fingerprints(frame(spark, ODD)).collect()
    assert all(r["fingerprint"] == slow_print(r["text"] or "").hex() and r["tree"] == "x" for r in rows)


def test_full_dictionaries_and_slabs(monkeypatch):
    monkeypatch.setattr(phrases, "DICTIONARY", 50)
    monkeypatch.setattr(phrases, "SLAB", 64)
    rng = random.Random(3)
    data = bytes(rng.choice(b"abcd") for _ in range(5_000)) + b"a" * 3_000
    parse = phrases.Parse().feed(data)
    starts = [0, *parse.ends[:-1]]
    assert {data[a:b] for a, b in zip(starts, parse.ends)} == slow_phrases(data, 50)
    cut = phrases.Parse().feed(data[:1_234])
    assert cut.fork().feed(data[1_234:]).ends == parse.ends and cut.ends != parse.ends
    monkeypatch.setattr(phrases, "SLAB", 1 << 20)
    whole = phrases.signature(data, parse)
    monkeypatch.setattr(phrases, "SLAB", 64)
    assert (phrases.signature(data, parse) == whole).all()


def test_likeness_estimates_the_share_of_phrases():
    rng, errors = random.Random(5), []
    for share in (0.1, 0.3, 0.5, 0.7, 0.9) * 8:
        text = "".join(rng.choice("etaoin shrdlu") for _ in range(3_000))
        other = text[:int(3_000 * share)] + "".join(rng.choice("etaoin shrdlu") for _ in range(3_000 - int(3_000 * share)))
        a, b = slow_phrases(text.encode()), slow_phrases(other.encode())
        errors.append(phrases.likeness(phrases.fingerprint(text), phrases.fingerprint(other)) - len(a & b) / len(a | b))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.05


# -- resampling -------------------------------------------------------------------------------------------------------


def test_cutoff_is_the_kth_key(spark):
    rng = random.Random(1)
    rows = [(-rng.randrange(30), rng.randrange(3), k) for k in range(3_000)]
    rows += [(-5, 1, 10_000 + k) for k in range(3_000)]  # a third and more with one score and id
    keys = spark.createDataFrame(rows, "a long, b long, c long").repartition(9)
    ordered = sorted(rows)
    for k in (1, 2, 1_500, 2_999, 4_321, len(rows)):
        assert importance.cutoff(keys, k) == ordered[k - 1]
    assert importance.cutoff(keys, 0) is None and importance.cutoff(keys, len(rows) + 1) is None


def test_rounds_discard_a_quarter(spark, monkeypatch):
    rounds, plain = [], importance._round
    monkeypatch.setattr(importance, "_round", lambda *a: rounds.append(plain(*a)) or rounds[-1])
    n = 4_000
    keys = spark.range(n).select(((F.col("id") * 7919) % n).alias("k")).repartition(5)
    assert importance.cutoff(keys, 200) == (199,)
    left = [sum(rounds[0][0].sizes)]
    for first, last, _ in rounds[1:]:
        assert max(sum(first.sizes), sum(last.sizes)) <= 0.75 * left[-1] + 1
        left.append(sum(first.sizes) if 200 <= sum(first.sizes) else sum(last.sizes))
        if len(left) > 4:
            break


def slow_resample(rows, target, percent, least):
    def features(text):
        words = importance.words_of(text)
        return words, [zlib.crc32(b" ".join(words[i:i + n])) % 10_000 for n in (1, 2, 3) for i in range(len(words) - n + 1)]

    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(features(text)[1])
    for text in target:
        t.update(features(text)[1])
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + 10_000) / ((s[b] + 1) * (t.total() + 10_000))))
    out = []
    for i, text in rows:
        words, found = features(text)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, found))
        out.append((len(words) >= least, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), i, len(found), weight))
    able = sorted((r for r in out if r[0]), key=lambda r: (-r[1], r[2] is not None, r[2] or 0, r[3]))
    drawn = Counter()
    ranks = [((*r[2:4], r[4], r[1]), k + 1) for k, r in enumerate(able) if k < len(able) * percent // 100]
    for key, _ in ranks:
        drawn[key] += 1
    rest = Counter((*r[2:4], r[4], r[1]) for r in out) - drawn
    return Counter([(*key, k) for key, k in ranks] + [(*key, None) for key in rest.elements()])


@pytest.mark.parametrize("percent", [0, 50, 100])
def test_resampling_of_odd_rows(spark, percent):
    rows = [(i, t) for i, t, _ in ODD] + [(k, f"word number {k % 9} the end") for k in range(100, 150)] + [(7, "THE end the END")] * 60
    target = ["the end of a word", None, "", "ünï cödé"]
    docs = frame(spark, [(i, t, "a") for i, t in rows]).repartition(6)
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    got = importance.resample(docs, bench, percent=percent, least_words=3)
    assert Counter(map(tuple, got.collect())) == slow_resample(rows, target, percent, 3)


# -- Merkle manifest --------------------------------------------------------------------------------------------------


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def slow_tree(level):
    levels = [level]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[i:i + 16]) for i in range(0, len(last), 16)])
    return levels


def slow_path(levels, i):
    for level in levels[:-1]:
        a = i - i % 16
        yield level[a:i], level[i + 1:a + 16]
        i //= 16


def slow_manifest(rows):
    """Of (doc_id, text, source): the contract's columns, without numbers and languages."""
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    lower = lambda t: t and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    leaf = lambda i, t, s: h(field(i), field(s), "-", "-", field(t))
    sources = {}
    for i, t, s in rows:
        sources.setdefault(s, []).append((i, t, leaf(i, t, s)))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        sources[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
        trees[s] = slow_tree([r[2] for r in sources[s]])
    top, out = slow_tree([trees[s][-1][0] for s in order]), []
    for k, s in enumerate(order):
        for j, (i, t, own) in enumerate(sources[s]):
            path = [*slow_path(trees[s], j), *slow_path(top, k)]
            node = leaf(i, lower(t), s) if i is not None and zlib.crc32(str(i).encode()) % 5 == 0 else own
            for left, right in path:
                node = h(*left, node, *right)
            proof = h(*(x for left, right in path for x in left + right))
            out.append((i, own, trees[s][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return out


def manifest_of(docs, **options):
    when = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    rows = merkle.leaves(docs, changed=lambda c: {"text": merkle.lower_ascii(c["text"])}, when=when)
    return merkle.build(rows, **options)


@pytest.mark.parametrize("levels", [2, 3, 4])
def test_manifest_of_odd_rows(spark, levels):
    rows = ODD + [(k, f"Text {k}", "large") for k in range(1_000, 1_600)] + [(k, "T", f"s{k}") for k in range(30)]
    got = merkle.prove(manifest_of(frame(spark, rows).repartition(5), block_levels=levels))
    assert Counter(map(tuple, got.collect())) == Counter(slow_manifest(rows))


def test_full_trees(spark):
    for n in (1, 16, 17, 256, 257):
        rows = [(k, "A", "a") for k in range(n)]
        got = merkle.prove(manifest_of(frame(spark, rows), block_levels=2))
        assert Counter(map(tuple, got.collect())) == Counter(slow_manifest(rows))


def test_layout_is_a_permutation_with_subtrees_together():
    for levels in range(1, 6):
        for n in {1, 2, 16 ** (levels - 1), max(1, 16 ** (levels - 1) - 5), max(1, 16 ** (levels - 1) // 3)}:
            if n > 16 ** (levels - 1):
                continue
            places = np.concatenate([merkle.place(k, np.arange(merkle.width(n, k)), n, levels) for k in range(levels)])
            assert sorted(places.tolist()) == list(range(merkle.size(n, levels)))
    # levels split in halves: every bottom subtree of two levels is one stretch, its root first
    leaves, roots = merkle.place(0, np.arange(4096), 4096, 4), merkle.place(1, np.arange(256), 4096, 4)
    assert (leaves.reshape(256, 16) == roots[:, None] + 1 + np.arange(16)).all()
    assert sorted(merkle.place(2, np.arange(16), 4096, 4).tolist()) == list(range(1, 17))


def test_manifest_is_independent_of_partitions(spark):
    docs = frame(spark, ODD)
    assert manifest_of(docs).root() == manifest_of(docs.repartition(9)).root()
    assert manifest_of(docs).root() != manifest_of(docs.where("doc_id != 11")).root()

"""SimHash classes against all pairs."""

import random

import numpy as np
import pytest
import xxhash

from clipquarry.llm import simhash
from clipquarry.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def slow_fingerprint(text, k=3):
    words, word = [], []
    for c in (text or ""):
        c = c.lower() if "A" <= c <= "Z" else c
        if c in " \t\n\x0b\x0c\r":
            if word:
                words.append("".join(word))
            word = []
        else:
            word.append(c)
    if word:
        words.append("".join(word))
    parts = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    votes = [0] * 64
    for p in parts:
        h = xxhash.xxh64_intdigest(p.encode(), 42)
        for b in range(64):
            votes[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(parts))


def slow_classes(prints, max_bits):
    """Of each row the rows reachable from it."""
    left, root = set(range(len(prints))), {}
    while left:
        seed = min(left)
        front, own = [seed], {seed}
        left.discard(seed)
        while front:
            a = front.pop()
            near = {b for b in left if (prints[a] ^ prints[b]).bit_count() <= max_bits}
            left -= near
            own |= near
            front += near
        for x in own:
            root[x] = own
    return root


def expected(rows, max_bits=2, k=3):
    prints = [slow_fingerprint(t, k) for _, t in rows]
    root = slow_classes(prints, max_bits)
    ids = lambda own: [rows[x][0] for x in own if rows[x][0] is not None]
    return sorted(
        (str(rows[i][0]), f"{prints[i]:016x}", str(min(ids(root[i]), default=None))) for i in range(len(rows))
    )


def got(df):
    return sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in df.collect())


def test_op8_against_all_pairs(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    want = expected([tuple(r) for r in docs])
    assert got(QUERIES["op8_simhash"](spark, SF_DIR)) == want
    assert len({w[2] for w in want}) < len(want)


def test_odd_rows(spark):
    rows = [(None, None), (4, None), (4, ""), (2, " \n"), (None, "one two three four"), (9, "One  TWO three\tfour"), (9, "Ä")]
    rows += [(30, "ä"), (31, "  x"), (8, "x" * 50_000), (7, "a b c d " * 9_000)] + [(12, "the same")] * 20
    docs = spark.createDataFrame([(*r, "e", 1) for r in rows], "doc_id long, text string, fingerprint string, component_id int")
    assert got(simhash.near_duplicates(docs)) == expected(rows)
    assert simhash.near_duplicates(docs.where("false")).count() == 0


@pytest.mark.parametrize("max_bits, bucket", [(0, 2048), (2, 2048), (2, 16), (5, 2048), (7, 24)])
def test_links_lose_nothing(spark, max_bits, bucket):
    """Clusters of fingerprints around centres, in buckets that are filed once and over again."""
    random.seed(max_bits)
    prints = set()
    for _ in range(12):
        centre = random.getrandbits(64)
        for _ in range(60):
            flips = random.sample(range(64), random.choice([0, 1, 2, 4, 8]))
            prints.add(centre ^ sum(1 << b for b in flips))
    while len(prints) < 1_000:
        prints.add(random.getrandbits(64))
    prints = sorted(prints)
    signed = [int(x) for x in np.array(prints, np.uint64).view(np.int64)]
    nodes = spark.createDataFrame([(x, x) for x in signed], "node long, fp long").repartition(5)
    edges = simhash.links(nodes, max_bits, bucket=bucket)
    roots = {r["node"]: r["root"] for r in simhash.classes(edges).collect()}
    want = slow_classes(prints, max_bits)
    for i, x in enumerate(signed):
        assert roots.get(x, x) == min(signed[j] for j in want[i])


def test_thresholds_add_up():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2, (500, 64))
    base[:, 32:] = base[:, :1]  # half of the bits are one
    for max_bits in (0, 2, 3, 7):
        plan = simhash.allocate(base.astype(np.uint8), range(64), max_bits)
        assert sum(t + 1 for _, t in plan) == max_bits + 1
        bits = [b for part, _ in plan for b in part]
        assert len(bits) == len(set(bits))
    parts = simhash.correlated_parts(base.astype(np.uint8), range(64), 2)
    assert sum(b >= 32 or b == 0 for b in parts[0]) in (0, 32)


def test_classes_of_a_long_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, i) for i in range(1001, 1400)], "a long, b long")
    roots = {r["node"]: r["root"] for r in simhash.classes(chain).collect()}
    assert {roots[i] for i in range(301)} == {0} and {roots[i] for i in range(1000, 1400)} == {1000}


def test_many_nodes_of_one_fingerprint(spark):
    """Hundreds of nodes share a fingerprint, or nearly, and differ in what is verified: no filing makes the bucket small."""
    rng = random.Random(8)
    flip = lambda x, n: x ^ sum(1 << b for b in rng.sample(range(64), n))
    centres = [(rng.getrandbits(64), rng.getrandbits(64)) for _ in range(40)]
    nodes = set()
    for fp in (0, 7, rng.getrandbits(64)):
        for _ in range(200):
            v1, v2 = rng.choice(centres)
            nodes.add((fp, flip(v1, rng.randrange(7)), flip(v2, rng.randrange(7))))
    nodes |= {(flip(0, rng.randrange(1, 12)), *rng.choice(centres)) for _ in range(100)}
    nodes = sorted(nodes)
    signed = np.array(nodes, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(i, *x) for i, x in enumerate(signed)], "node long, fp long, v1 long, v2 long").repartition(3)
    edges = simhash.links(df, 7, verify=["v1", "v2"], verify_bits=24, bucket=16)
    roots = {r["node"]: r["root"] for r in simhash.classes(edges).collect()}
    left, want = set(range(len(nodes))), {}
    while left:
        front = [min(left)]
        own = set(front)
        left -= own
        while front:
            f, v, w = nodes[front.pop()]
            near = {
                b for b in left if (f ^ nodes[b][0]).bit_count() <= 7
                and (v ^ nodes[b][1]).bit_count() + (w ^ nodes[b][2]).bit_count() <= 24
            }
            left -= near
            own |= near
            front += near
        want |= dict.fromkeys(own, min(own))
    assert {i: roots.get(i, i) for i in want} == want
    assert 1 < len(set(want.values())) < len(nodes)

"""Every stage of the pipeline against a plain version of it, each on its own input."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline as cp
from clipquarry.llm import quality, simhash
from clipquarry.llm.common import store
from tests.llm.test_mixing_decontamination_topk_warc import slow_words

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def read(df):
    return [tuple(r) for r in df.select(*COLUMNS).collect()]


def odd_rows(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    base = [rng.choice(words) for _ in range(300)]
    rows = []
    for k in range(12):  # near copies of one text
        own = list(base)
        for _ in range(k % 3 + 1):
            own[rng.randrange(300)] = rng.choice(words)
        rows.append((100 + k, " ".join(own), "en", "s", 1))
    rows += [(200 + k, " \n".join(base[:200]).upper() if k % 2 else " ".join(base[:200]), "en", "s", 1) for k in range(40)]
    rows += [(None, None, None, None, None), (7, None, "en", "s", 0), (7, "", "en", "s", 0), (8, " \n ", "en", None, 0)]
    rows += [(None, "a text with no id", "en", "s", 1), (9, "one two", "de", "s", 1), (9, "one two", "de", "t", 2)]
    rows += [(10, " ".join(rng.choice(words) for _ in range(20_000)), "en", "big", 3)]
    rows += [(20 + i, " ".join(rng.choice(words) for _ in range(80)), "en", "s", 1) for i in range(30)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF_DIR}/documents.parquet"), []
    for name, stage in cp.STAGES:
        after = store(stage(spark, docs, SF_DIR), name)
        out.append((docs, after))
        docs = after
    return out


def test_columns(stages):
    assert all(after.columns == before.columns for before, after in stages[:-1])
    assert 4 <= len(cp.STAGES) <= 5 and cp.ORACLE_SQL is None


def test_quality(spark, stages):
    before, after = stages[0]
    grader = quality.Grader(quality.train(before, spark.read.parquet(f"{SF_DIR}/labels.parquet")))

    def tail(text):
        own = (text or "").split()
        z = sum(float(grader.weights[quality._hash(f)]) for w in own for f in ("w=" + w.lower(), "s=" + quality.shape(w)))
        z = z / max(len(own), 1) + sum(float(grader.weights[f]) for f in quality.text_features(text or "", own))
        return 1 / (1 + math.exp(grader.thresholds[0] - z))

    assert Counter(read(after)) == Counter(r for r in read(before) if tail(r[1]) >= quality.LEAST_TAIL)
    assert after.count() < before.count()


def slow_keep(rows):
    prints = []
    for r in rows:
        own = (r[1] or "").encode().lower().split()
        parts = [b" ".join(own[i:i + 3]) for i in range(max(1, len(own) - 2))] if own else []
        votes = np.array([[xxhash.xxh64_intdigest(p, 42) >> b & 1 for b in range(64)] for p in parts]).reshape(-1, 64)
        prints.append(sum(1 << b for b in range(64) if 2 * votes[:, b].sum() > len(parts)))
    left, kept = set(range(len(rows))), []
    while left:
        front = [left.pop()]
        own = set(front)
        while front:
            a = prints[front.pop()]
            near = {b for b in left if (a ^ prints[b]).bit_count() <= 2}
            left -= near
            own |= near
            front += near
        kept.append(min((rows[i][0] is None, rows[i][0] or 0) for i in own))
    return sorted(kept)


@pytest.mark.parametrize("odd", [False, True])
def test_near_duplicates(spark, stages, odd):
    before = odd_rows(spark) if odd else stages[1][0]
    after = cp.near_duplicate_stage(spark, before, SF_DIR)
    rows, kept = read(before), read(after)
    assert after.columns == before.columns and not Counter(kept) - Counter(rows)
    assert sorted((r[0] is None, r[0] or 0) for r in kept) == slow_keep(rows)
    assert len(kept) < len(rows)
    few = [r[0] for r in kept if 200 <= (r[0] or 0) < 300]
    assert not odd or few == [200]  # copies that differ in case and blanks only


def test_decontamination(spark, stages):
    before, after = stages[2]
    grams = {}
    for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect():
        own = slow_words(r["text"])
        n = min(13, len(own))
        grams.setdefault(n, set()).update(tuple(own[i:i + n]) for i in range(len(own) - n + 1))

    def clean(text):
        own, hit = slow_words(text), set()
        for n, known in grams.items():
            for i in range(len(own) - n + 1):
                if n and tuple(own[i:i + n]) in known:
                    hit |= set(range(i, i + n))
        return not hit or 20 * len(hit) < len(own)

    assert Counter(read(after)) == Counter(r for r in read(before) if clean(r[1]))
    assert after.count() < before.count()


def slow_mix(rows):
    size = Counter()
    for r in rows:
        size[r[3]] += len(r[1] or "")
    weight = {s: math.sqrt(n) for s, n in size.items() if n}
    out = Counter()
    for r in rows:
        if r[3] not in weight:
            continue
        rate = sum(size.values()) * weight[r[3]] / sum(weight.values()) / size[r[3]]
        parts = max(1, math.ceil(rate / 500))
        md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
        key = md5(f"42|{'-' if r[0] is None else r[0]}|{'-' if r[1] is None else md5(r[1])}")
        for j in range(1, parts + 1):
            u = int(md5(f"{key}#{j}")[:13], 16) / 16**13
            p = c = math.exp(-rate / parts)
            k = 0
            while c <= u and k < 5_000:
                k += 1
                p *= rate / parts / k
                c += p
            out[r] += k
    return +out


@pytest.mark.parametrize("odd", [False, True])
def test_mixing(spark, stages, odd):
    before = odd_rows(spark) if odd else stages[3][0]
    after = cp.mixing_stage(spark, before, SF_DIR)
    assert after.columns == before.columns and Counter(read(after)) == slow_mix(read(before))


def test_tokens(spark, stages):
    before, after = stages[4]
    tokenizer, want, start = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), [], 0
    for r in sorted(read(before), key=lambda r: r[0]):
        ids = [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1]
        want.append((r[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, after.collect())) == want


def test_odd_rows_and_empty_tables_pass_all_stages(spark):
    docs = odd_rows(spark)
    for name, stage in cp.STAGES:
        assert stage(spark, docs.where("false"), SF_DIR).count() == 0, name
        assert stage(spark, docs, SF_DIR).count() > 0, name
    wide = docs.withColumnsRenamed({"n_chars": "node", "lang": "copy"}).selectExpr("*", "1 AS row", "2 AS fp", "3 AS root", "4 AS first", "5 AS best")
    for name, stage in cp.STAGES[:-1]:
        assert stage(spark, wide, SF_DIR).columns == wide.columns, name


def test_run(spark, stages):
    assert sorted(map(tuple, cp.run(spark, SF_DIR).collect())) == sorted(map(tuple, stages[-1][1].collect()))
    assert simhash.deduplicate(stages[1][1]).count() == stages[1][1].count()

"""The three learned operators: exact inner parts by brute force, accuracy on held-out rows."""

import itertools
import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clipquarry.llm import language, quality, toxicity
from clipquarry.llm.common import held_out, labelled_sample
from clipquarry.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


def batch(rows):
    return iter([pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.string())], ["label", "text"])])


@pytest.fixture(scope="module")
def labels(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}


# --- toxicity ------------------------------------------------------------------------------------------


def test_marginals_by_enumeration():
    rng = np.random.default_rng(0)
    lengths = np.array([3, 0, 1, 5])
    emission, trans = rng.normal(size=9), rng.normal(size=(2, 2))
    got, counts = toxicity.expectations(emission, lengths, trans)
    want, pairs, at = np.zeros(9), np.zeros((2, 2)), 0
    for n in lengths:
        paths = list(itertools.product((0, 1), repeat=int(n)))
        weight = [math.exp(sum(emission[at + t] * y for t, y in enumerate(p)) + sum(trans[a, b] for a, b in zip(p, p[1:]))) for p in paths]
        for p, w in zip(paths, weight):
            for t, y in enumerate(p):
                want[at + t] += y * w / sum(weight)
            for a, b in zip(p, p[1:]):
                pairs[a, b] += w / sum(weight)
        at += n
    assert np.allclose(got, want) and np.allclose(counts, pairs)


def test_spans_and_scores_of_odd_texts(spark):
    clean = [f"the day {w} was fine and the sun {w}s over hill {i}" for i in range(60) for w in ("goes", "sets")]
    toxic = [f"the day {w}{i} vileword was and you {i} uglyword fine" for i in range(60) for w in ("goes", "sets", "runs", "sings")]
    model = toxicity.fit(batch([(0, t) for t in clean] + [(1, t) for t in toxic] + [(1, None), (0, "")]))
    tagger = toxicity.Tagger(model)
    text = "İ the vileword uglyword was, Fine VILEWORD"
    scores, spans = tagger.score([text, None, "", "... !", "the day was fine", "fine " * 30_000 + "vileword"])
    assert scores[0] >= 0.7 and max(scores[1:5]) < 0.3
    assert [text[a:b] for a, b, _ in spans[0]] == ["vileword uglyword", "VILEWORD"] and spans[1:5] == [[]] * 4
    rows = [(None, text, 1.0, 1), (1, None, 0.0, 0), (1, "", 0.0, 0), (2, text, 0.0, 0), (2, text, 0.0, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double, predicted int")
    out = toxicity.score_toxicity(docs, model)
    assert sorted((str(r["doc_id"]), r["predicted"], len(r["spans"])) for r in out.collect()) == [
        ("1", 0, 0), ("1", 0, 0), ("2", 1, 2), ("2", 1, 2), ("None", 1, 2)]
    assert toxicity.score_toxicity(docs.where("false"), model).count() == 0
    nothing = toxicity.Tagger(toxicity.fit(batch([(0, "a b")])))
    assert nothing.score(["vileword", None])[0].max() < 0.5


def test_op3_on_held_out_rows(spark, labels):
    rows = QUERIES["op3_toxicity"](spark, SF_DIR).collect()
    assert len(rows) == 1_000 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [(r["predicted"], labels[r["doc_id"]]["toxic"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    bad, good = [p for p, y in held if y], [p for p, y in held if not y]
    assert sum(bad) >= 0.7 * len(bad) and sum(good) <= 0.03 * len(good)  # 33 toxic documents to learn from


# --- quality -------------------------------------------------------------------------------------------


def test_grades_are_ordered(spark):
    words = ["zero", "one", "two", "three"]
    rows = [(g, f"{words[g]} thing {i} and {words[g]} more") for g in range(4) for i in range(60)]
    model = quality.fit(batch(rows + [(0, None), (0, "")]))
    grader = quality.Grader(model)
    assert np.all(np.diff(grader.thresholds) > 0)
    expected = [grader.score(f"{w} thing 99 and {w} more")[0] for w in words]
    assert expected == sorted(expected) and expected[0] < 0.8 and expected[-1] > 2.2
    # by the definition of the model
    text = "two thing 7 and two more"
    own = text.split()
    z = sum(float(grader.weights[f]) for w in own for f in quality.word_features(w)) / len(own)
    z += sum(float(grader.weights[f]) for f in quality.text_features(text, own))
    above = [1 / (1 + math.exp(t - z)) for t in grader.thresholds]
    assert np.allclose(grader.score(text), (sum(above), above[0]))
    one = quality.Grader(quality.fit(batch([(1, "a")])))
    assert one.score("anything") == (1.0, 1.0) and quality.Grader(quality.fit(batch([]))).score(None)[1] == 1.0


def test_selection_keeps_columns_and_odd_rows(spark):
    model = quality.fit(batch([(g, ("LOUD!! " if g == 0 else "calm ") * 20 + str(i)) for g in (0, 1) for i in range(40)]))
    rows = [(None, "calm " * 20, "x", 1.0), (2, "LOUD!! " * 20, "x", 1.0), (3, None, None, None), (3, "", "", 0.0), (4, "calm " * 30_000, "", 0.0), (4, "calm " * 30_000, "", 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string, expected_grade double")
    kept = quality.select_quality(docs, model)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert 2 not in ids and None in ids and ids.count(4) == 2 and ids.count(3) in (0, 2)
    assert quality.select_quality(docs.where("false"), model).count() == 0


def test_op2_on_held_out_rows(spark, labels):
    rows = QUERIES["op2_quality"](spark, SF_DIR).collect()
    assert len(rows) == 1_000
    held = [(r["keep"], labels[r["doc_id"]]["quality"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    bad, good = [k for k, y in held if not y], [k for k, y in held if y]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.4 * len(bad)


def test_samples_are_bounded(spark):
    docs = spark.createDataFrame([(i % 50 if i < 300 else 7, f"t{i % 60}", 1) for i in range(900)], "doc_id long, text string, label int")
    known = spark.createDataFrame([(i, i % 2) for i in range(50)] + [(None, 1), (3, None), (3, 0)], "doc_id long, mark int")
    got = labelled_sample(docs, known, 20, doc_id="doc_id", label="mark").groupBy("label").count().collect()
    assert {r["label"]: r["count"] for r in got} == {0: 20, 1: 20}


# --- language ------------------------------------------------------------------------------------------

TEXTS = [
    (0, "the house is old and the garden is green", "en"), (1, "das Haus ist alt und der Garten ist grün", "de"),
    (2, "la maison est vieille et le jardin est vert", "fr"), (3, "the the THE house's", "en"), (4, None, "en"),
    (5, "", "de"), (6, "12 345", "fr"), (7, "house garden", None), (8, "Haus Häuser", "de"),
]


def frame(spark, rows=TEXTS):
    return spark.createDataFrame([(*r, 1.0, "z") for r in rows], "doc_id long, text string, lang string, score double, lang_pred string")


def test_counts_by_brute_force(spark):
    want, grams = {}, {}
    for _, text, lang in TEXTS:
        word = ""
        for c in (text or "").lower() + " ":
            if c.isalpha():
                word += c
            elif word:
                if lang:
                    want[lang, word] = want.get((lang, word), 0) + 1
                    for n in (1, 2, 3, 4):
                        marked = f"^{word}$" if n > 1 else word
                        for i in range(len(marked) - n + 1):
                            grams[lang, marked[i:i + n]] = grams.get((lang, marked[i:i + n]), 0) + 1
                word = ""
    counts = language.count_words(frame(spark))
    assert {(r["lang"], r["item"]): r["n"] for r in counts.collect()} == want
    assert {(r["lang"], r["item"]): r["n"] for r in language.count_grams(counts).collect()} == grams


def test_backs_off_to_shorter_grams(spark):
    model = language.train(frame(spark))
    find = language.Identifier(model)
    texts = ["the house", "maison", "Gärten gartenhaus", "grüne", "vieux", "ü", "日本", "7 !", None, "", "the " * 50_000]
    got = find.predict(texts)
    assert [g[0] for g in got[:4]] == ["en", "fr", "de", "de"] and [g[0] for g in got[7:10]] == ["und"] * 3
    assert got[10][0] == "en" and all(0 <= s <= 1 for _, s in got)
    known = [n for n in (4, 3, 2, 1) if any(g in model.grams[n] for g in language.grams("gärtner", n))]
    rows = [model.gram_logs[known[0]][model.grams[known[0]][g]] for g in language.grams("gärtner", known[0]) if g in model.grams[known[0]]]
    assert np.allclose(model.backoff("gärtner"), np.mean(rows, axis=0))
    assert got[6] == ("de", pytest.approx(1 / 3))  # nothing known: all languages alike, the first by name
    rows = [(None, "the house", None), (3, None, "x"), (3, "das Haus", "y"), (3, "das Haus", "y")]
    out = language.identify(frame(spark, rows), model).collect()
    assert sorted((str(r["doc_id"]), r["lang_pred"]) for r in out) == [("3", "de"), ("3", "de"), ("3", "und"), ("None", "en")]
    empty = frame(spark).where("false")
    assert language.identify(empty, model).count() == 0
    assert {r["lang_pred"] for r in language.identify(frame(spark), language.train(empty)).collect()} == {"und"}


def test_model_size_is_bounded(spark):
    rows = [(i, " ".join(f"w{chr(97 + i % 26)}{chr(97 + j)}" for j in range(i % 9)), "ab"[i % 2]) for i in range(200)]
    counts = language.count_words(frame(spark, rows))
    kept = language.most_frequent(counts, 30).where("lang = 'a'").count()
    assert 0 < kept <= 60 and language.most_frequent(counts, 10**6).count() == counts.count()


def test_op4_on_held_out_rows(spark):
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang").collect()}
    rows = QUERIES["op4_language"](spark, SF_DIR).where(held_out("doc_id") == F.col("held_out")).collect()
    assert len(rows) == 1_000
    held = [truth[r["doc_id"]] == r["lang_pred"] for r in rows if r["held_out"]]
    assert sum(held) >= 0.98 * len(held)


def test_samples_of_large_labels_are_the_smallest_hashes(spark):
    from clipquarry.llm.common import labelled_sample

    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("text"))
    labels = docs.select("doc_id", F.when(F.col("doc_id") < 50, 0).otherwise(1).alias("grade"))
    got = labelled_sample(docs, labels, 300, doc_id="doc_id", label="grade").collect()
    hashed = labels.withColumn("h", F.xxhash64("doc_id")).orderBy("h").collect()
    want = {(r["grade"], f"t{r['doc_id']}") for g in (0, 1) for r in [r for r in hashed if r["grade"] == g][:300]}
    assert {tuple(r) for r in got} == want and len(got) == 350
    # one id on very many rows, all alike
    many = docs.where("doc_id < 40").unionByName(spark.range(20_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("same").alias("text")))
    got = labelled_sample(many, labels, 300, doc_id="doc_id", label="grade").collect()
    assert len(got) == 300 and {r["label"] for r in got} == {0} and "same" in {r["text"] for r in got}
    assert labelled_sample(docs.where("false"), labels, 9, doc_id="doc_id", label="grade").count() == 0

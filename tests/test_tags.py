import random
import time

import pyarrow as pa

import pytest
from pyspark.sql import functions as F

from clipquarry import schema as sc
from clipquarry.functions import tags as tg
from clipquarry.operators import scoring
from clipquarry.plans import taggers
from workload.fixtures import PieceCut

STRINGS = "array<string>"


def one(spark, schema, values, column):
    return spark.createDataFrame([values], schema).select(column.alias("x")).first()["x"]


def spans(spark, tags):
    return [tuple(r) for r in one(spark, f"t {STRINGS}", (tags,), tg.entity_spans("t"))]


def test_spans(spark):
    assert spans(spark, ["B-a", "I-a", "O", "B-a"]) == [("a", 0, 1), ("a", 3, 3)]
    assert spans(spark, ["O", "I-a", "I-a"]) == [("a", 1, 2)]
    assert spans(spark, ["B-a", "I-b", "B-b"]) == [("a", 0, 0), ("b", 1, 1), ("b", 2, 2)]
    assert spans(spark, ["B-creative-work", "I-creative-work"]) == [("creative-work", 0, 1)]
    assert spans(spark, []) == []
    assert spans(spark, ["O", None, "B-a"]) == [("a", 2, 2)]


def test_histogram(spark):
    schema = f"t {STRINGS}"
    assert one(spark, schema, (["a", "b", "a"],), tg.tag_histogram("t")) == {"a": 2, "b": 1}
    assert one(spark, schema, (["a", "b", "a"],), tg.tag_histogram("t", ["b", "c"])) == {"b": 1}
    assert one(spark, schema, (None,), tg.tag_histogram("t")) == {}


def aligned_by_hand(words, pieces, labels):
    """Brute force: replay the rule with a queue of pieces."""
    queue = list(zip([p.replace("##", "").replace("Ġ", "") for p in pieces], labels))
    result = []
    for word in words:
        label, glued = "O", ""
        while queue and word.startswith(glued + queue[0][0]):
            text, tag = queue.pop(0)
            glued += text
            if glued == word:
                label = tag
                break
        result.append(label)
    return result


def align(spark, words, pieces, labels):
    schema = f"a {STRINGS}, p {STRINGS}, l {STRINGS}"
    return one(spark, schema, (words, pieces, labels), tg.align_tokens("a", "p", "l"))


def test_align_city(spark):
    found = align(
        spark, ["New", "York", "City"], ["New", "York", "Ci", "##ty"], ["B-LOC", "I-LOC", "I-LOC", "I-LOC"]
    )
    assert found == ["B-LOC", "I-LOC", "I-LOC"]


def test_align_against_brute_force(spark):
    draw = random.Random(1)
    cases = []
    for _ in range(300):
        words = ["".join(draw.choices("ab", k=draw.randint(1, 4))) for _ in range(draw.randint(0, 6))]
        pieces = []
        for word in words:
            while word:
                k = draw.randint(1, len(word))
                pieces.append(("##" if draw.random() < 0.3 else "") + word[:k])
                word = word[k:]
        if pieces and draw.random() < 0.5:
            pieces[draw.randrange(len(pieces))] = draw.choice(["a", "Ġb", "zz", ""])
        cases.append((words, pieces, [f"L{i}" for i in range(len(pieces))]))
    df = spark.createDataFrame(cases, f"a {STRINGS}, p {STRINGS}, l {STRINGS}")
    for row in df.withColumn("x", tg.align_tokens("a", "p", "l")).collect():
        assert row["x"] == aligned_by_hand(row["a"], row["p"], row["l"]), row


def test_align_rows_of_one_batch():
    """Nulls, empty strings, departures in the middle, letters of several bytes, missing labels."""
    draw, cases = random.Random(4), [(None, [], []), (["a"], None, []), ([], ["a"], ["L"]), (["a"], [], [])]
    cases += [(["é", "日本", "x"], ["é", "日", "本", "y"], ["A", "B", "C", "D"]), (["", "a"], ["", "a"], ["A", "B"])]
    for _ in range(500):
        words = ["".join(draw.choices("aé日", k=draw.randint(0 if draw.random() < 0.1 else 1, 4))) for _ in range(draw.randint(0, 8))]
        pieces = []
        for word in words:
            while word:
                k = draw.randint(1, len(word))
                pieces.append(word[:k])
                word = word[k:]
        for _ in range(draw.randint(0, 2)):
            if pieces:
                pieces[draw.randrange(len(pieces))] = draw.choice(["a", "zz", "", "é"])
        cases.append((words, pieces, [f"L{i}" for i in range(len(pieces))]))
    strings = pa.list_(pa.string())
    found = tg._aligned(*[pa.array([c[i] for c in cases], strings) for i in range(3)]).to_pylist()
    for case, labels in zip(cases, found):
        assert labels == (None if None in case else aligned_by_hand(*case)), case


def test_alignment_is_linear():
    def seconds(n, hurt):
        words = [f"word{i}x" for i in range(n)]
        pieces = [p for w in words for p in (w[:3], w[3:5], w[5:])]
        if hurt:
            pieces[3] = "?"
        arrays = [pa.array([x], pa.list_(pa.string())) for x in (words, pieces, pieces)]
        start = time.perf_counter()
        tg._aligned(*arrays)
        return time.perf_counter() - start

    for hurt in (False, True):
        seconds(8_000, hurt)
        assert min(seconds(80_000, hurt) for _ in range(3)) < 30 * min(seconds(8_000, hurt) for _ in range(3))


def test_alignment_takes_short_rows_at_once():
    words = [f"word{i}x" for i in range(200_000)]
    pieces = [p for w in words for p in (w[:3], w[3:5], w[5:])]

    def seconds(n):
        cut = lambda x: pa.array([x[i * len(x) // n:(i + 1) * len(x) // n] for i in range(n)], pa.list_(pa.string()))
        arrays = [cut(x) for x in (words, pieces, pieces)]
        start = time.perf_counter()
        tg._aligned(*arrays)
        return time.perf_counter() - start

    seconds(1)
    assert min(seconds(20_000) for _ in range(3)) < 4 * min(seconds(1) for _ in range(3))


def test_densify(spark):
    schema = f"p {STRINGS}, e array<struct<index:int,word:string,entity:string>>"
    pieces = ["New", "York", "Ci", "##ty", "x"]
    entities = [(1, "New", "B"), (2, "Ci", "X"), (3, "##ty", "Y"), (9, "x", "Z"), (4, "ty", "Y2")]
    found = one(spark, schema, (pieces, entities), tg.densify_labels("p", "e"))
    assert found == ["B", "O", "X", "Y2", "O"]
    assert one(spark, schema, (pieces, []), tg.densify_labels("p", "e")) == ["O"] * 5
    assert one(spark, schema, ([], entities), tg.densify_labels("p", "e")) == []


def test_first_subword(spark):
    schema = f"w array<int>, t {STRINGS}"
    found = one(spark, schema, ([None, 0, 0, 2, None], list("ABCDE")), tg.first_subword_labels("w", "t", 4))
    assert found == ["B", "O", "D", "O"]
    assert one(spark, schema, ([], []), tg.first_subword_labels("w", "t", 0)) == []


def test_merge_entities(spark):
    schema = f"w {STRINGS}, l {STRINGS}"
    words = ["x", "Ber", "##lin", "and", "##er", "IBM", "co"]
    labels = ["I-LOC", "B-LOC", "I-LOC", "O", "I-LOC", "B-org", "B-x"]
    found = one(spark, schema, (words, labels), tg.merge_entities("w", "l"))
    assert [tuple(r) for r in found] == [("Berliner", "LOCATION"), ("IBM", "ORGANIZATION"), ("co", "X")]
    assert one(spark, schema, (["a"], ["O"]), tg.merge_entities("w", "l")) == []


def test_mappings(spark):
    assert sc.TO_FOUR_ENTITIES["B-group"] == "B-ORG"
    assert sc.TO_FOUR_ENTITIES["I-creative-work"] == "I-MISC"
    assert sc.TO_FOUR_ENTITIES["O"] == "O"
    assert all(k == v for k, v in sc.SAME_TAGS.items()) and len(sc.SAME_TAGS) == 13
    assert set(map(id, sc.TAGGER_MAPPINGS.values())) == {id(sc.TO_FOUR_ENTITIES), id(sc.SAME_TAGS)}
    tagset = lambda *t: spark.createDataFrame([(x,) for x in t], "tag string")
    derived = scoring.derive_tag_mapping(tagset("B-a", "I-a", "B-b-c", "O", "O"), tagset("O", "I-a", "B-b-c"))
    assert {tuple(r) for r in derived.collect()} == {
        ("B-a", "O"), ("I-a", "I-a"), ("B-b-c", "B-b-c"), ("O", "O"),
    }
    assert one(spark, f"t {STRINGS}", (["B-person", "B-what"],), tg.map_tags("t", sc.SAME_TAGS)) == [
        "B-person", "O",
    ]
    assert one(spark, "t array<int>", ([1, 0],), tg.tag_names("t", ["O", "B-x"])) == ["B-x", "O"]


@pytest.fixture(scope="module")
def tagged(spark):
    rows = [
        (1, ["B-a", "I-a", "O", "B-b"], ["B-a", "I-a", "O", "O"]),
        (2, ["O", "B-a", "O"], ["B-b", "B-a", "O"]),
        (3, ["O"], ["O"]),
    ]
    return spark.createDataFrame(rows, f"sent_id int, gold {STRINGS}, pred {STRINGS}")


def test_scores(tagged):
    row = scoring.span_scores(tagged).first()
    assert (row["precision"], row["recall"]) == (2 / 3, 2 / 3)


def test_report(tagged):
    rows = {r["type"]: r for r in scoring.span_report(tagged).collect()}
    assert (rows["a"]["precision"], rows["a"]["recall"], rows["a"]["support"]) == (1.0, 1.0, 2)
    assert (rows["b"]["f1"], rows["b"]["support"]) == (0.0, 1)
    assert rows["macro avg"]["f1"] == 0.5
    assert rows["weighted avg"]["recall"] == pytest.approx(2 / 3)
    assert rows["micro avg"]["support"] == 3


def test_nothing_tagged_scores_zero(spark):
    df = spark.createDataFrame([(["O"], ["O"])], f"gold {STRINGS}, pred {STRINGS}")
    assert tuple(scoring.span_scores(df).first()) == (0.0, 0.0, 0.0)


def test_tag_sets(spark):
    a = spark.createDataFrame([("x",), ("y",), ("x",)], "tag string")
    b = spark.createDataFrame([("y",), ("z",)], "tag string")
    found = scoring.tag_set_difference(a, b).collect()
    assert {tuple(r) for r in found} == {("x", "left"), ("z", "right")}
    assert scoring.tag_set_difference(a, a).count() == 0


def test_evaluations_map_the_gold_side(spark):
    words = spark.createDataFrame(
        [(["Bob", "ran"], ["B-person", "O"], [None, 0, 0, 1], ["O", "B-PER", "I-PER", "O"])],
        f"tokens {STRINGS}, gold {STRINGS}, word_ids array<int>, subword_tags {STRINGS}",
    )
    rows = {r["type"]: r["f1"] for r in taggers.evaluate_words(words, sc.TO_FOUR_ENTITIES).collect()}
    assert rows["PER"] == 1.0
    pieces = spark.createDataFrame(
        [(["Bobby", "ran"], ["B-person", "O"], ["Bob", "##by", "ran"], [(1, "Bob", "B-PER"), (2, "##by", "B-PER")])],
        f"tokens {STRINGS}, gold {STRINGS}, pieces {STRINGS}, "
        "entities array<struct<index:int,word:string,entity:string>>",
    )
    rows = {r["type"]: r["f1"] for r in taggers.evaluate_pieces(pieces, sc.TO_FOUR_ENTITIES).collect()}
    assert rows["PER"] == 1.0


def test_labels_of_missing_and_repeated_entries(spark):
    df = spark.createDataFrame(
        [(["a", "##b", "c"], None, [0, 0, 1, None, 7, 1], ["X", "Y", None, "Z", "W", "V"])],
        "p array<string>, e array<struct<index:int,word:string,entity:string>>, ids array<int>, t array<string>",
    )
    row = df.select(tg.densify_labels("p", "e").alias("d"), tg.first_subword_labels("ids", "t", 3).alias("f")).first()
    assert row["d"] == ["O", "O", "O"] and row["f"] == ["X", "O", "O"]


def test_tag_functions_take_long_rows(spark):
    n = 40_000
    row = spark.range(1).select(
        F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.concat(F.lit("w"), i.cast("string"))).alias("p"),
        F.sequence(F.lit(0), F.lit(n - 1)).alias("ids"),
    )
    entities = F.transform("p", lambda w, i: F.struct((i + 1).alias("index"), w.alias("word"), F.lit("B-x").alias("entity")))
    found = row.select(
        F.size(F.filter(tg.densify_labels("p", entities), lambda t: t == "B-x")).alias("d"),
        F.size(F.filter(tg.first_subword_labels("ids", "p", n), lambda t: t.startswith("w"))).alias("f"),
    ).first()
    assert (found["d"], found["f"]) == (n, n)  # minutes if each place were looked for in the whole row


def test_pieces_of_a_batch():
    draw = random.Random(7)
    tokens = [["".join(draw.choices("aBé日", k=draw.randint(1, 15))) for _ in range(draw.randint(1, 9))] for _ in range(60)]
    gold = [[draw.choice(["O", "B-person", "I-group"]) for _ in t] for t in tokens]
    strings = pa.list_(pa.string())
    some = slice(5, 55)  # a batch may be a slice
    found = PieceCut(*[pa.array(x, strings)[some] for x in (tokens, gold)])
    columns = {c: getattr(found, c)().to_pylist() for c in ("pieces", "word_ids", "subword_tags", "entities")}
    for r, (words, tags) in enumerate(zip(tokens[some], gold[some])):
        plain = []
        for i, (w, t) in enumerate(zip(words, tags)):
            t = "O" if len(w) % 7 == 0 else t
            plain += [(("##" if k else "") + w[k:k + 4], i, t if t == "O" or not k else "I" + t[1:]) for k in range(0, len(w), 4)]
        assert columns["pieces"][r] == [p for p, _, _ in plain]
        assert columns["word_ids"][r] == [None] + [i for _, i, _ in plain]
        assert columns["subword_tags"][r] == ["O"] + [t for _, _, t in plain]
        assert columns["entities"][r] == [{"index": n, "word": p, "entity": t} for n, (p, _, t) in enumerate(plain, 1) if t != "O"]

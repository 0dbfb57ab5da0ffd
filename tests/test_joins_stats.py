import pytest
from pyspark.sql import functions as F

from clipquarry.operators import filters, joins, prefix, segments, stats
from clipquarry.schema import CLIP


def test_merge_update(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("a", 4)], "id string, n int")
    source = spark.createDataFrame([("a", "u"), ("z", "v"), ("z", "w"), (None, "x")], "id string, uri string")
    rows = joins.merge_update(target, source, "id", {"link": "uri"}).collect()
    assert {(r["n"], r["link"]) for r in rows} == {(1, "u"), (2, None), (3, None), (4, "u")}
    updated = joins.merge_update(
        target.withColumn("link", F.lit("old")), source, "id", {"link": "uri"}
    ).collect()
    assert {(r["n"], r["link"]) for r in updated} == {(1, "u"), (2, "old"), (3, "old"), (4, "u")}


def test_merge_update_refuses_several_sources(spark):
    target = spark.createDataFrame([("a",)], "id string")
    source = spark.createDataFrame([("a", "u"), ("a", "v")], "id string, uri string")
    with pytest.raises(Exception, match="several source rows"):
        joins.merge_update(target, source, "id", {"link": "uri"}).collect()


def test_attach_selection_pairs_duplicate_ids(spark):
    orig = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "id string, n int")
    selected = spark.createDataFrame([("a", 10), ("a", 20)], "id string, t int")
    rows = joins.attach_selection(orig, selected).collect()
    assert sorted((r["n"], r["t"]) for r in rows) == [(1, 10), (1, 20), (2, 10), (2, 20)]


@pytest.mark.parametrize("bound", ["BROADCAST_ROWS", "BROADCAST_BYTES"])
def test_large_selections_are_not_broadcast(spark, monkeypatch, bound):
    monkeypatch.setattr(prefix, bound, 1)
    orig = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "id string, n int")
    keys = spark.createDataFrame([("a", 7), ("b", 8)], "id string, t int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = joins.attach_selection(orig, keys)
        assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()
        assert {(r["n"], r["t"]) for r in joined.collect()} == {(1, 7), (2, 8)}
        assert joins.restrict_to_keys(orig, keys, "id").count() == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_join_back(spark):
    orig = spark.createDataFrame([("a", "x", 5)], "raw_filepath string, human_transcript_text string, duration int")
    sel = orig.withColumn("proper_noun_ratio", F.lit(0.5))
    assert joins.join_back(orig, sel).columns == [
        "raw_filepath", "human_transcript_text", "duration", "temp_duration", "temp_proper_noun_ratio",
    ]
    assert joins.join_back(orig, sel, columns=["proper_noun_ratio"]).columns[-1] == "proper_noun_ratio"


def test_overlay(spark):
    orig = spark.createDataFrame([("a", 1, "p"), ("a", 2, "q")], "k string, v int, w string")
    sel = spark.createDataFrame([("a", 9), ("z", 8)], "k string, v int")
    rows = joins.overlay(orig, sel, "k", F.col("w").desc()).collect()
    assert {(r["k"], r["v"], r["w"]) for r in rows} == {("a", 9, "q"), ("z", 8, None)}


def test_restrict_with_cap(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    keys = spark.range(50).withColumnRenamed("id", "k").union(spark.range(5).withColumnRenamed("id", "k"))
    assert joins.restrict_to_keys(df, keys, "k").count() == 50
    kept = joins.restrict_to_keys(df, keys, "k", 3, F.col("k").desc())
    assert sorted(r["k"] for r in kept.collect()) == [47, 48, 49]


def test_pair_audio(spark):
    named = lambda *n: spark.createDataFrame([(x,) for x in n], "audio_name string")
    rows = joins.pair_audio(
        named("a.wav", "b.mp3", "c.flac", "d.mp3", "e.wav"), named("a.wav", "b.mp3", "c.flac"), named("a.wav", "d.mp3")
    ).collect()
    assert {tuple(r) for r in rows} == {("a.wav", "present"), ("c.flac", "upload"), ("d.mp3", "present")}


def test_existence(spark):
    wanted = spark.createDataFrame([("x",), ("y",), (None,)], "p string")
    listing = spark.createDataFrame([("x", 1), ("x", 2)], "path string, length long")
    assert [r["p"] for r in joins.present_objects(wanted, listing, "p").collect()] == ["x"]
    assert {r["p"] for r in joins.missing_objects(wanted, listing, "p").collect()} == {"y", None}


@pytest.fixture(scope="module")
def clips(spark):
    def cats(evidence):
        one = {"density": len(evidence) / 10, "count": len(evidence), "exists": bool(evidence), "evidence": evidence}
        none = {"density": None, "count": None, "exists": None, "evidence": None}
        return {"email": one, **{c: none for c in ("proper_noun", "address", "alphanumeric", "phone_number", "website")}}

    rows = [
        ("a", "p.wav", "text one. Two", 100, cats(["x", "y", "x"])),
        ("a", "q.wav", "text two.", 200, cats(["x"])),
        ("b", None, "♪ text three", 300, cats([])),
    ]
    return spark.createDataFrame(rows, CLIP)


def test_evidence(clips):
    counted = stats.aggregate_evidence(clips, "email")
    assert sorted(tuple(r) for r in counted.collect()) == [("a", "x", 3), ("a", "y", 1)]
    assert [tuple(r) for r in stats.evidence_arrays(counted).collect()] == [("a", ["x", "x", "x", "y"])]


def test_much_evidence_of_one_id(spark):
    hot = [("hot", [f"e{i}" for i in range(50)] + ["same"] * 40), ("cold", ["c"])]
    df = spark.createDataFrame(hot, "id string, e array<string>").select(
        "id", F.struct(F.struct(F.col("e").alias("evidence")).alias("email")).alias("categories")
    )
    counted = stats.aggregate_evidence(df, "email")
    assert {(r["id"], r["evidence"]): r["n"] for r in counted.collect()}["hot", "same"] == 40
    arrays = {r["id"]: r["aggregated_evidence"] for r in stats.evidence_arrays(counted).collect()}
    assert arrays == {"hot": sorted(hot[0][1]), "cold": ["c"]}


def test_category_statistics(clips):
    exact = stats.category_statistics(clips, "email", exact=True).first()
    sketch = stats.category_statistics(clips, "email").first()
    assert exact["total_email_count"] == 4 and exact["P50_duration"] == 200
    assert len(exact) == 15 and exact.asDict().keys() == sketch.asDict().keys()
    assert sketch["P99_duration"] == 300


def test_profiles(clips):
    basic = filters.quality_filter(clips, "basic", count="categories.email.count")
    assert [r["transcoded_filepath"] for r in basic.collect()] == ["p.wav"]
    assert filters.quality_filter(clips, "basic", count="categories.website.count").count() == 0
    with pytest.raises(ValueError):
        filters.quality_filter(clips, "other")


def test_parameters():
    filters.validate_params("email", "count", "raw_filepath")
    for bad in (("emails",), ("email", "sum"), ("email", "count", "path")):
        with pytest.raises(ValueError):
            filters.validate_params(*bad)


def test_statistics_and_lines(spark):
    df = spark.createDataFrame([(1, 2.0, None)], "n int, x double, gone double")
    lines = stats.statistics_lines(df).collect()
    assert [tuple(r) for r in lines] == [("n", "1"), ("x", "2.000"), ("gone", "None")]
    assert tuple(stats.ratio_statistics(df.filter("n > 1"), "x").first()) == (None,) * 5


def test_histograms_and_counts(spark):
    df = spark.createDataFrame([({"a": 2, "b": 1},), ({"a": 1, "c": -1},), ({},), (None,)], "h map<string,long>")
    assert {tuple(r) for r in stats.merge_histograms(df, "h").collect()} == {("a", 3), ("b", 1)}
    assert {r["total_count"] for r in stats.with_total_count(df).collect()} == {4}
    assert stats.row_count(df).first()[0] == 4


def test_dense_sections(spark):
    listed = [("One", 3), ("Two ", 4), ("low", 0), ("Three", 3)]
    df = spark.createDataFrame([(0, 9, listed)], "start_ms int, end_ms int, sentences array<struct<text:string,proper_nouns:int>>")
    assert [r["section"] for r in segments.dense_sections(df).collect()] == ["One Two"]
    kept = segments.dense_sections(df, keep_trailing=True).collect()
    assert [r["section"] for r in kept] == ["One Two", "Three"]


def test_chunks(spark):
    df = spark.createDataFrame([("a", " ".join(str(i) for i in range(25))), ("b", ""), ("c", None)], "id string, t string")
    rows = segments.token_chunks(df, "t", 10, 3).collect()
    assert [len(r["tokens"]) for r in rows] == [10, 10, 5]
    assert [r["context"] for r in rows] == [[], ["7", "8", "9"], ["17", "18", "19"]]

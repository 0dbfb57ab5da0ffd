"""Versioned tables, key filters, listings by tasks, and stored sketches."""

import os
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from clipquarry.operators import joins, keyfilter, prefix, sketches
from clipquarry.sources import files, versions


def stored(spark, path, n=200):
    rows = spark.range(n).select(F.col("id").cast("string").alias("id"), (F.col("id") * 2).alias("x"))
    return versions.create_versioned(rows.repartitionByRange(8, "id"), str(path), "id")


def names(spark, path, version=None):
    return {r["file"] for r in versions.live_files(spark, str(path), version).collect()}


def test_only_touched_files_are_written_anew(spark, tmp_path):
    stored(spark, tmp_path)
    first = names(spark, tmp_path)
    source = spark.createDataFrame([("17", "a"), ("170", "b"), ("none", "c"), (None, "d")], "id string, uri string")
    touched = {r["file"] for r in versions.touched_files(spark, str(tmp_path), source, "id").collect()}
    got = versions.merge_versioned(spark, str(tmp_path), source, "id", {"uri": "uri"})
    second = names(spark, tmp_path)
    assert 0 < len(touched) < len(first) and first - second == touched
    want = {str(i): (2 * i, {17: "a", 170: "b"}.get(i)) for i in range(200)}
    assert {r["id"]: (r["x"], r["uri"]) for r in got.collect()} == want and got.count() == 200
    old = versions.read_version(spark, str(tmp_path), 1)
    assert old.columns == ["id", "x"] and old.count() == 200
    rows = versions.live_files(spark, str(tmp_path)).agg(F.sum("rows")).first()[0]
    assert rows == 200 and versions.current_version(spark, str(tmp_path)) == 2


def test_a_failed_update_leaves_the_table(spark, tmp_path):
    stored(spark, tmp_path)
    first = names(spark, tmp_path)
    twice = spark.createDataFrame([("17", "a"), ("17", "b")], "id string, uri string")
    with pytest.raises(PySparkException, match="several source rows"):
        versions.merge_versioned(spark, str(tmp_path), twice, "id", {"uri": "uri"})
    assert versions.current_version(spark, str(tmp_path)) == 1 and names(spark, tmp_path) == first
    assert versions.read_version(spark, str(tmp_path)).count() == 200
    # a writer that comes second is refused
    with pytest.raises(PySparkException):
        stored(spark, tmp_path)
    assert names(spark, tmp_path) == first


def test_updates_without_a_match_and_of_empty_tables(spark, tmp_path):
    stored(spark, tmp_path / "a")
    none = spark.createDataFrame([("x", 1)], "id string, x long")
    assert versions.merge_versioned(spark, str(tmp_path / "a"), none, "id", {"x": "x"}).count() == 200
    assert versions.current_version(spark, str(tmp_path / "a")) == 1
    empty = versions.create_versioned(none.where("false"), str(tmp_path / "b"), "id")
    assert empty.count() == 0 and empty.columns == ["id", "x"]
    assert versions.merge_versioned(spark, str(tmp_path / "b"), none, "id", {"x": "x"}).count() == 0
    again = spark.createDataFrame([("5", 7)], "id string, x long")
    updated = versions.merge_versioned(spark, str(tmp_path / "a"), again, "id", {"x": "x"})
    assert {r["x"] for r in updated.where("id = '5'").collect()} == {7} and updated.schema["x"].dataType.simpleString() == "bigint"


def test_a_filter_keeps_every_key_and_few_others(spark):
    keys = spark.range(1_000_000).select((F.col("id") * 3).cast("string").alias("k"))
    rows = spark.range(300_000).select(F.when(F.col("id") % 10 > 0, F.col("id").cast("string")).alias("k"))
    words = keyfilter.key_words(keys, "k", 1_000_000)
    assert len(words) * 8 <= 4 << 20
    kept = keyfilter.may_hold(rows, "k", words)
    matched = rows.join(keys, "k", "left_semi").count()
    assert kept.join(keys, "k", "left_semi").count() == matched
    assert matched <= kept.count() <= matched + 0.02 * (300_000 - matched)
    assert keyfilter.may_hold(rows, "k", keyfilter.key_words(keys.where("false"), "k", 0)).count() == 0


def test_large_selections_thin_the_table_before_the_shuffle(spark, monkeypatch):
    monkeypatch.setattr(prefix, "BROADCAST_ROWS", 10)
    orig = spark.range(50_000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("o"), F.lit("x").alias("text"))
    orig = orig.unionByName(orig.where("k < 100").withColumn("o", F.lit(9).cast("long")))
    chosen = spark.range(0, 50_000, 50).select(F.col("id").alias("k"), F.lit(1).alias("m"))
    joined = joins.join_back(orig, chosen, "k", "text")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan[plan.index("Exchange"):]  # below the exchange of the original rows
    assert joined.count() == 1_002
    over = joins.overlay(orig, chosen, "k", [F.col("o").desc()])
    plan = over._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan[plan.index("Window"):]
    assert {r["k"]: r["o"] for r in over.where("k < 150").collect()} == {0: 9, 50: 9, 100: 2}


def test_tasks_list_what_the_driver_lists(spark, tmp_path):
    draw = random.Random(2)
    for i in range(60):
        folder = tmp_path.joinpath("root", *[f"d{draw.randrange(3)} é+%" for _ in range(draw.randrange(4))])
        os.makedirs(folder, exist_ok=True)
        (folder / f"f{i}.bin").write_bytes(b"x" * (i + 1))
    os.makedirs(tmp_path / "root" / "empty")
    (tmp_path / "root" / "_SUCCESS").write_bytes(b"")
    (tmp_path / "root" / "nothing").write_bytes(b"")  # which a file source does not list, as there is nothing to read
    root = str(tmp_path / "root")
    want = sorted(map(tuple, files.list_objects(spark, root).collect()))
    for uri in (root, f"file://{root}", f"file:{root}"):
        assert sorted(map(tuple, files.list_in_tasks(spark, uri).where("length > 0").collect())) == want
        assert files.list_in_tasks(spark, uri).count() == 61
    assert len(want) == 60 and files.list_in_tasks(spark, root + "/empty").count() == 0


def test_merged_sketches_are_those_of_all_rows(spark):
    draw = random.Random(7)
    rows = [(f"day{i % 9}", f"c{i % 2}", None if i % 50 == 0 else draw.lognormvariate(3, 1)) for i in range(20_000)]
    df = spark.createDataFrame([*rows, ("late", "c9", None)], "day string, cat string, x double").repartition(6)
    parts = sketches.sketch_parts(df, ["x"], ["day", "cat"])
    found = {r["cat"]: r for r in sketches.sketch_statistics(sketches.merge_parts(parts, ["x"], ["cat"]), ["x"]).collect()}
    for cat in ("c0", "c1"):
        own = sorted(x for _, c, x in rows if c == cat and x is not None)
        mean = sum(own) / len(own)
        assert found[cat]["mean_x"] == pytest.approx(mean)
        assert found[cat]["variance_x"] == pytest.approx(sum((x - mean) ** 2 for x in own) / (len(own) - 1))
        for p in (50, 90, 99):
            rank = sum(x <= found[cat][f"P{p}_x"] for x in own) / len(own)
            assert abs(rank - p / 100) <= sketches.RANK_ERROR
    assert found["c9"]["mean_x"] is None and found["c9"]["P50_x"] is None
    assert all(len(r["x_sketch"]) < 20_000 for r in parts.select("x_sketch").collect())

"""One ordered file from many tasks, and arrays read in ranges."""

import glob
import io
import json
import os
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from clipquarry.sources import files, ordered


def manifest(spark, n):
    odd = ["a\tb", 'say "x"', "two\nlines", "", None, "é日🙂", "plain", "\\", " lead"]
    rows = [(i, f"p/{i}", odd[i % len(odd)], "set") for i in range(n)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, files.MANIFEST).repartition(7)


@pytest.mark.parametrize("n", [0, 1, 500])
def test_a_file_equals_that_of_one_task(spark, tmp_path, n):
    df, path = manifest(spark, n), str(tmp_path / "out" / "manifest.tsv")
    ordered.write_manifest_file(df, path)
    one = df.orderBy("Index").coalesce(1) if n else df.coalesce(1)
    files.write_manifest(one, str(tmp_path / "plain"))
    (part,) = glob.glob(str(tmp_path / "plain" / "part-*"))
    with open(path, "rb") as a, open(part, "rb") as b:
        assert a.read() == b.read()
    assert os.listdir(tmp_path / "out") == ["manifest.tsv"]


def test_a_failed_write_leaves_the_old_file(spark, tmp_path):
    path = tmp_path / "manifest.tsv"
    path.write_text("old")
    broken = manifest(spark, 90).withColumn("Labels", F.when(F.col("Index") == 77, F.raise_error(F.lit("lost"))).otherwise(F.col("Labels")))
    with pytest.raises(PySparkException):
        ordered.write_manifest_file(broken, str(path))
    assert path.read_text() == "old" and os.listdir(tmp_path) == ["manifest.tsv"]
    with pytest.raises(ValueError, match="ranged writes"):
        ordered_elsewhere(broken)


def ordered_elsewhere(df):
    real = ordered.store_of
    try:
        ordered.store_of = lambda uri: (object(), uri, "")
        ordered.write_ordered(df, F.col("Paths"), "s3://bucket/x", ["Index"])
    finally:
        ordered.store_of = real


RECORDS = [
    {"t": 'q"uo\\te\\\\"', "n": 1}, {"t": "[{]}", "n": 2}, {"t": "", "n": None}, {"t": "é日🙂" * 30, "n": 4},
    {"t": "\\" * 37, "n": 5}, {"t": "\\" * 38 + '"', "n": 6}, {"t": "x" * 700, "n": 7}, {"n": 8}, {"t": "{\"t\": 1},\n", "n": 9},
]


@pytest.mark.parametrize("text", ["[]", " [ ] ", json.dumps(RECORDS), "\ufeff" + json.dumps(RECORDS * 9, indent=1, ensure_ascii=False)])
@pytest.mark.parametrize("segment, look", [(1 << 20, 256), (13, 2)])
def test_any_cut_gives_the_same_records(monkeypatch, text, segment, look):
    data = text.encode()

    class File:
        def size(self):
            return len(data)

        def read_at(self, n, at):
            return data[at:at + n]

    monkeypatch.setattr(ordered, "RANGE", segment)
    monkeypatch.setattr(ordered, "BEYOND", segment)
    monkeypatch.setattr(ordered, "LOOK_BACK", look)
    want = json.loads(text.removeprefix("\ufeff"))
    states = [(False, 0)]
    for at in range(len(data)):  # the state before every byte
        _, change, quote = ordered._depths(ordered.np.frombuffer(data[at:at + 1], ordered.np.uint8), ordered._escaped(File(), at), states[-1][0])
        states.append((states[-1][0] ^ bool(quote.sum()), states[-1][1] + int(change.sum())))
    for step in (1, 7, 64, 1_000, len(data)):
        got = []
        for start in range(0, len(data), step):
            got += ordered.json_records(File(), start, min(start + step, len(data)), *states[start])
        assert [json.loads(r) for r in got] == want


def test_arrays_are_read_by_many_tasks(spark, tmp_path):
    path = tmp_path / "a.json"
    path.write_text("\ufeff" + json.dumps(RECORDS * 20, ensure_ascii=False), encoding="utf-8")
    want = sorted(((r.get("t"), r["n"]) for r in RECORDS * 20), key=str)
    for step in (97, 1_000, 1 << 20):
        rows = ordered.read_json_array(spark, str(path), "t string, n long", range_bytes=step)
        assert sorted(map(tuple, rows.collect()), key=str) == want
        assert step > 97 or rows.rdd.getNumPartitions() > 50


@pytest.mark.parametrize("text", ['[1, {"a": 2}]', '[{"a": 2}, "x"]', '[[{"a": 2}]]', '[{"a": 2}, {"a": '])
def test_other_arrays_are_refused(text):
    class File(io.BytesIO):
        def size(self):
            return len(text)

        def read_at(self, n, at):
            return text.encode()[at:at + n]

    with pytest.raises(ValueError):
        list(ordered.json_records(File(), 0, len(text), False, 0))


def test_manifest_file_is_read_in_ranges(spark, tmp_path):
    labels = ["plain", "two\nlines", 'a "quote"', "tab\there", "é\r\n\"\n\"", "", None, "\n", "x" * 300] * 4
    rows = [(i, f"p{i}", label, "d") for i, label in enumerate(labels)]
    df = spark.createDataFrame(rows, files.MANIFEST)
    path = f"{tmp_path}/m.tsv"
    ordered.write_manifest_file(df, path)
    whole = sorted(map(tuple, files.read_manifest(spark, path).collect()))
    for n in (7, 100, 1 << 20):
        read = ordered.read_manifest_file(spark, path, range_bytes=n)
        assert sorted(map(tuple, read.collect())) == whole, n
    assert len(whole) == len(rows)


def test_short_ranges_of_large_files_do_not_make_more_tasks(spark, tmp_path):
    most = ordered.TASKS * spark.sparkContext.defaultParallelism
    array = tmp_path / "a.json"
    array.write_text(json.dumps(RECORDS * 50, ensure_ascii=False), encoding="utf-8")
    rows = ordered.read_json_array(spark, str(array), "t string, n long", range_bytes=10)
    assert array.stat().st_size // 10 > 3 * most and rows.rdd.getNumPartitions() == most
    assert sorted(map(tuple, rows.collect()), key=str) == sorted(((r.get("t"), r["n"]) for r in RECORDS * 50), key=str)
    want = [(i, f"p{i}", 'two\n"lines"', "d") for i in range(500)]
    ordered.write_manifest_file(spark.createDataFrame(want, files.MANIFEST), f"{tmp_path}/m.tsv")
    rows = ordered.read_manifest_file(spark, f"{tmp_path}/m.tsv", range_bytes=10)
    assert rows.rdd.getNumPartitions() == most
    assert sorted(map(tuple, rows.collect())) == want


def test_short_ranges_read_little_behind_their_end():
    class File(io.BytesIO):
        read_in_all = 0

        def size(self):
            return len(self.getvalue())

        def read_at(self, n, at):
            self.read_in_all += n
            return self.getvalue()[at:at + n]

    file = File(json.dumps([{"t": "x" * 1_000}] * 3_000).encode())
    step, got = 60_000, 0
    for start in range(0, file.size(), step):
        before = file.getvalue()[:start]
        inside = before.count(b'"') % 2 == 1
        depth = sum(before.count(c) for c in (b"[", b"{")) - before.count(b"}")
        got += len(list(ordered.json_records(file, start, min(start + step, file.size()), inside, depth)))
    assert got == 3_000
    assert file.read_in_all < 2 * file.size()  # 18 times before
    rows = File(b"h\n" + b"".join(b"%d\t%s\n" % (i, b"x" * 1_000) for i in range(3_000)))
    got = sum(len(list(ordered.manifest_records(rows, at, min(at + step, rows.size()), False))) for at in range(0, rows.size(), step))
    assert got == 3_000
    assert rows.read_in_all < 2 * rows.size()

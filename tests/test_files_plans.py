import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clipquarry.functions.ids import decode_id
from clipquarry.functions.paths import stem
from clipquarry.plans import curation, manifest, metrics
from clipquarry.schema import CLIP
from clipquarry.sources import files, tables
from clipquarry.streaming.stateless import measured_clips


def write(path, text, encoding="utf-8"):
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)


def test_transcript_files(spark, tmp_path):
    write(tmp_path / "a+ b%é.wav.txt", "  two\nlines \n")
    write(tmp_path / "notes.md", "x")
    rows = files.read_transcript_files(spark, str(tmp_path)).collect()
    assert [tuple(r) for r in rows] == [("a+ b%é.wav", "two\nlines")]


def test_many_transcript_files_are_read_by_few_tasks(spark, tmp_path, monkeypatch):
    for i in range(1_500):  # a task for every 32 before
        write(tmp_path / f"{i}.txt", f" t{i}\n")
    want = sorted((str(i), f"t{i}") for i in range(1_500))
    for together, tasks in ((10_000, 4 * spark.sparkContext.defaultParallelism), (50, 30)):
        monkeypatch.setattr(files, "READ_TOGETHER", together)
        monkeypatch.setattr(files, "HELD", together)
        rows = files.read_transcript_files(spark, f"file://{tmp_path}")
        assert rows.rdd.getNumPartitions() == tasks
        assert sorted(map(tuple, rows.collect())) == want


@pytest.mark.parametrize("below, names", [("other", ["_b=", "a", "bytes", "e%20+é"]), ("lang=de", ["f"])])
def test_transcript_files_are_those_of_the_file_source(spark, tmp_path, below, names):
    for folder in (below, "x.txt", ".hidden"):
        (tmp_path / folder).mkdir()
    for name in ("a.txt", "_b.txt", "_b=.txt", ".c.txt", ".txt", "d.TXT", "e%20+é.txt", f"{below}/f.txt"):
        write(tmp_path / name, f"\ufeff {name}\r\n")
    write(tmp_path / "empty.txt", "")
    (tmp_path / "gone.txt").symlink_to(tmp_path / "nothing")
    (tmp_path / "bytes.txt").write_bytes(b"\xff\xfe a\x80 ")
    hexed = lambda df: sorted(map(tuple, df.select("audio_name", F.hex("transcript")).collect()))
    found = hexed(files.read_transcript_files(spark, str(tmp_path)))
    source = spark.read.option("pathGlobFilter", "*.txt").text(str(tmp_path), wholetext=True)
    name = F.regexp_extract(files.decoded("_metadata.file_name"), r"(?s)^(.*)\.txt$", 1)
    assert found == hexed(source.select(name.alias("audio_name"), files.strip_text("value").alias("transcript")))
    assert [n for n, _ in found] == names


def test_transcript_files_by_a_pattern(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    assert files.read_transcript_files(spark, str(tmp_path / "empty")).collect() == []
    write(tmp_path / "a.txt", "one")
    write(tmp_path / "b.txt", "two")
    for path, want in (("a.txt", ["one"]), ("[ab].txt", ["one", "two"])):
        assert sorted(r["transcript"] for r in files.read_transcript_files(spark, str(tmp_path / path)).collect()) == want


def test_vendor_json(spark, tmp_path):
    write(tmp_path / "a.json", '[{"words":[{"text":"He"},{"text":"is "}]},{"words":[{"text":"in"}]}]', "utf-8-sig")
    write(tmp_path / "b.json", "[]")
    write(tmp_path / "c.json", "no json")
    found = {os.path.basename(r["uri"]): r["label"] for r in files.read_vendor_json(spark, str(tmp_path)).collect()}
    assert found == {"a.json": "He is  in", "b.json": "", "c.json": None}


def test_listing(spark, tmp_path):
    (tmp_path / "d").mkdir()
    write(tmp_path / "d" / "x.wav", "12345")
    rows = files.list_objects(spark, str(tmp_path)).collect()
    assert [(os.path.basename(r["path"]), r["length"]) for r in rows] == [("x.wav", 5)]


def test_manifest_text(spark, tmp_path):
    label = 'tab\there "quoted"\nnew line'
    rows = [(0, "gs://a/b.wav", label, "set"), (2, "gs://a/c.wav", "", "set")]
    df = spark.createDataFrame(rows, files.MANIFEST).coalesce(1)
    path = str(tmp_path / "m")
    files.write_manifest(df, path)
    part = next(p for p in os.listdir(path) if p.startswith("part-"))
    import csv

    with open(os.path.join(path, part), newline="") as f:
        read = list(csv.reader(f, delimiter="\t"))
    assert read[0] == ["Index", "Paths", "Labels", "Dataset"]
    assert read[1] == ["0", "gs://a/b.wav", label, "set"]
    assert files.read_manifest(spark, path).first()["Labels"] == label


def test_json_and_log(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, {"x": 2})], "k string, n int, h map<string,int>")
    path = str(tmp_path / "j")
    tables.write_json(df, path, ["h", "missing", "k"])
    assert set(tables.load_results(spark, path).columns) == {"h", "k"}
    lines = spark.createDataFrame([("mean", "0.500")], "key string, value string")
    tables.write_stats_log(lines, str(tmp_path / "log"))
    assert spark.read.text(str(tmp_path / "log")).first()[0] == "mean: 0.500"


def test_catalog_tables(spark, tmp_path):
    name = "clip_table"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    assert not tables.table_exists(spark, name)
    path = str(tmp_path / "warehouse")
    spark.sql(f"CREATE TABLE {name} (id INT) USING parquet LOCATION 'file:{path}'")
    try:
        tables.write_table(spark.range(3).selectExpr("cast(id as int) id"), name)
        assert tables.table_exists(spark, name) and tables.read_table(spark, name, ["id"]).count() == 3
        tables.write_table(spark.range(5).selectExpr("cast(id as int) id"), name, "ignore")
        assert tables.read_table(spark, name).count() == 3
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_schema_listing(spark):
    df = spark.createDataFrame([], CLIP)
    fields = {r["field"]: r["type"] for r in tables.describe_schema(df).collect()}
    assert fields["duration"] == "bigint" and fields["categories.email.density"] == "double"
    assert fields["categories.email.evidence"] == "array<string>"


CLIP_PATHS = ["g/a.wav", "g/b.FLAC", "g/c.m4a", "g/d.webm", "g/e.mp3", "g/f"]


def test_routes(spark):
    df = spark.createDataFrame([(p,) for p in CLIP_PATHS], "transcoded_filepath string")
    routed = manifest.media_route(df, "out", "set")
    rows = {r["transcoded_filepath"]: r for r in routed.withColumn("n", decode_id(stem("destination"))).collect()}
    assert [rows[p]["action"] for p in CLIP_PATHS] == ["copy", "copy", "convert", "convert", "skip", "skip"]
    assert [rows[p]["target_ext"] for p in CLIP_PATHS] == ["wav", "flac", "wav", "flac", None, None]
    assert [rows[p]["n"] for p in CLIP_PATHS[:4]] == ["a", "b", "c", "d"]
    assert rows["g/e.mp3"]["destination"] is None
    forced = manifest.media_route(df, "out", "set", transcode=True).collect()
    assert [r["action"] for r in forced] == ["skip", "skip", "convert", "convert", "skip", "skip"]


def test_skipped_clips_leave_gaps(spark):
    df = spark.createDataFrame([(p, f"text {p}") for p in CLIP_PATHS], "transcoded_filepath string, transcript string")
    rows = manifest.build_manifest(df, "set", "out", "dir", ["transcoded_filepath"], [False], name=stem("transcoded_filepath"))
    found = {r["Index"]: r["Paths"] for r in rows.collect()}
    assert found == {
        2: "gs://out/dir/d.flac", 3: "gs://out/dir/c.wav", 4: "gs://out/dir/b.flac", 5: "gs://out/dir/a.wav",
    }


def test_vendor_flow(spark):
    table = spark.createDataFrame(
        [("a", "g/1.wav"), ("a", "g/2.wav"), ("b", "g/3.wav"), ("c", "g/4.wav")], "id string, transcoded_filepath string"
    )
    pointers = spark.createDataFrame([("a", "u1"), ("c", "u2")], "id string, transcript_gcs_uri string")
    labels = spark.createDataFrame([("u1", "hello"), ("u2", "")], "uri string, label string")
    pointed = manifest.attach_vendor_uri(curation.for_each_category({"email": table, "website": table}), pointers)
    rows = manifest.vendor_manifest(pointed, labels, "set", ["transcoded_filepath"]).collect()
    assert sorted((r["Index"], r["Paths"], r["Labels"], r["Dataset"]) for r in rows) == sorted(
        (i, f"{c}_set/{n}.wav", t, f"{c}_set")
        for c in ("email", "website")
        for i, n, t in ((0, 1, "hello"), (3, 4, ""))
    )


def test_tagger_is_made_once_per_task(spark, tmp_path):
    folder = str(tmp_path)

    def make():
        open(os.path.join(folder, f"{os.urandom(4).hex()}.made"), "w").close()
        return lambda texts: [(t.split(), ["O"] * len(t.split())) for t in texts]

    df = spark.createDataFrame([(f"a b {i}",) for i in range(50)] + [(None,)], "transcript string").coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        rows = metrics.annotate(df, make).filter(F.size("tokens") > 0).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(rows) == 50 and rows[3]["tags"] == ["O", "O", "O"]
    assert len(os.listdir(folder)) == 1


def test_unknown_mode():
    with pytest.raises(ValueError):
        metrics.noun_ratio("other")


def test_columns_work_on_streams(spark, tmp_path):
    schema = (
        "transcript string, duration long, transcoded_filepath string, tags array<string>, pos array<string>, "
        "entities array<struct<text:string,label:string>>"
    )
    rows = [("Ann met Bob today. Then left.", 100, "x", ["B-person", "O", "B-person", "O", "O", "O"], None, None)]
    source = str(tmp_path / "in")
    spark.createDataFrame(rows, schema).write.parquet(source)
    stream = spark.readStream.schema(schema).parquet(source)
    query = (
        measured_clips(stream, "strict", "tagged_words")
        .writeStream.format("memory").queryName("measured").outputMode("append").start()
    )
    query.processAllAvailable()
    query.stop()
    assert spark.table("measured").first()["proper_noun_ratio"] == pytest.approx(1 / 3)
    from clipquarry.operators.budgets import running_budget

    with pytest.raises(ValueError, match="streaming"):
        running_budget(stream, "duration", "duration")


def test_checkpoints_go_to_the_configured_folder(spark):
    from clipquarry.session import scratch_path, shared_dir

    assert scratch_path(spark, "x").startswith(shared_dir(spark).rstrip("/"))


def test_top_hours_are_published(spark, tmp_path):
    from clipquarry.plans.publish import publish_top_hours

    rows = [("f1", 1800, "Ann met Bob", ["B-person", "O", "B-person"]), ("f2", 3000, "went off", ["O", "O"])]
    orig = spark.createDataFrame(
        rows, "raw_filepath string, duration long, human_transcript_text string, tags array<string>"
    )
    annotated = orig.withColumns(
        {
            "entities": F.lit(None).cast("array<struct<text:string,label:string>>"),
            "pos": F.lit(None).cast("array<string>"),
        }
    )
    chosen = curation.select_top_hours(annotated, "tagged_words", 1)
    folder = str(tmp_path / "out")
    table = publish_top_hours(orig, chosen, f"{folder}/table", folder, ["raw_filepath", "duration", "absent"])
    assert [(r["raw_filepath"], r["temp_proper_noun_ratio"]) for r in table.collect()] == [("f1", 2 / 3)]
    read = lambda name: tables.load_results(spark, f"{folder}/{name}").collect()
    assert [r.asDict() for r in read("selected_data")] == [{"raw_filepath": "f1", "duration": 1800}]
    assert read("statistics")[0]["P50"] == 2 / 3
    assert [(r["tag"], r["count"]) for r in read("tag_distribution")] == [("B-person", 2)]


@pytest.mark.parametrize("category", ["proper_noun", "email"])
def test_a_category_is_published(spark, tmp_path, category):
    from clipquarry.plans.publish import publish_category
    from clipquarry.schema import CATEGORIES

    def cats(n):
        one = {"density": n / 10, "count": n, "exists": n > 0, "evidence": ["x"] * n}
        return {c: one for c in CATEGORIES}

    rows = [(str(i), f"g/{i}.wav", f"Text of {i}. More.", 100, cats(i)) for i in range(6)]
    clips = spark.createDataFrame(rows, CLIP)
    name = f"published_{category}"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    args = (category, name, "set", "bkt", str(tmp_path / "out"))
    try:
        table = publish_category(clips, *args, limit=300)
        assert sorted(r["id"] for r in table.collect()) == ["3", "4", "5"]
        kept = publish_category(clips, *args, limit=100)
        assert kept.count() == 3
        again = publish_category(clips, *args, limit=100, replace=True)
        assert [r["id"] for r in again.collect()] == ["5"]
        manifest_rows = files.read_manifest(spark, str(tmp_path / "out" / "manifest")).collect()
        assert [(r["Index"], r["Labels"]) for r in manifest_rows] == [(0, "Text of 5. More.")]
        log = {r[0] for r in spark.read.text(str(tmp_path / "out" / "statistics")).collect()}
        assert "total_duration: 100" in log and f"mean_{category}_count: 5.000" in log
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


# --- taggers that take few words at a time ----------------------------------------------------------


def counting_tagger(limit, calls=None):
    """Marks a word that stands in the same call before; refuses long inputs."""

    def make():
        def tag(chunks):
            if max(map(len, chunks)) > limit or len(chunks) > 4:
                raise ValueError("too much at once")
            return [["R" if w in words[:i] else "O" for i, w in enumerate(words)] for words in chunks]

        return tag

    return make


def slow_tags(words, size, context):
    out = []
    for i, w in enumerate(words):
        first = i - i % size
        out.append("R" if w in words[max(first - min(context, size), 0) if first else 0:i] else "O")
    return out


@pytest.mark.parametrize("size, context", [(512, 10), (5, 2), (3, 7), (1, 0)])
def test_chunks_are_tagged_with_their_context(spark, size, context):
    rows = [(0, None), (1, ""), (2, " \n"), (3, "a"), (4, "a b a"), (5, "x y " * 700), (6, " ".join(str(k % 37) for k in range(2_000)))]
    rows += [(10 + k, "w " * k) for k in range(30)]
    df = spark.createDataFrame(rows, "id int, transcript string").repartition(3)
    options = {"size": size, "context": context, "together": 4}
    want = {i: slow_tags(t.split(), size, context) for i, t in rows if t is not None}
    whole = {r["id"]: r for r in metrics.annotate_chunked(df, counting_tagger(size + context), **options).collect()}
    assert {i: r["tags"] for i, r in whole.items() if i} == want and whole[0]["tags"] is None
    assert all(whole[i]["tokens"] == t.split() for i, t in rows if i)
    chunks = metrics.tag_chunks(df, counting_tagger(size + context), **options).orderBy("id", "chunk").collect()
    joined = {}
    for r in chunks:
        joined.setdefault(r["id"], []).extend(r["tags"])
    assert joined == {i: t for i, t in want.items() if t}


def test_a_text_of_a_hundred_thousand_words(spark):
    words = [str(k * k % 1_009) for k in range(100_000)]
    df = spark.createDataFrame([(1, " ".join(words))], "id int, transcript string")
    tags = metrics.annotate_chunked(df, counting_tagger(522), together=4).first()["tags"]
    assert tags == slow_tags(words, 512, 10)


def test_taggers_that_lose_words_are_refused():
    for tagger in (lambda chunks: [w[1:] for w in chunks], lambda chunks: []):
        with pytest.raises(ValueError, match="returned"):
            list(metrics.tag_together(iter([([], ["a", "b"])]), tagger, 4))


def test_a_tagger_gets_portions_of_text(spark):
    def make():
        def tag(texts):
            if sum(map(len, texts)) > metrics.PORTION:
                raise ValueError("more text than a portion")
            return [(t.split(), ["O"] * len(t.split())) for t in texts]

        return tag

    texts = [("word " * 2_000,) for _ in range(400)] + [(None,), ("",)]
    rows = metrics.annotate(spark.createDataFrame(texts, "transcript string").coalesce(1), make).collect()
    assert [len(r["tokens"]) for r in rows] == [2_000] * 400 + [0, 0]
    assert [len(p) for p in metrics.portions(pa.array(["aa", None, "b", "cccc", ""]), 3)] == [3, 1, 1]

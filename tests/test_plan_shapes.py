"""What the plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

from clipquarry.operators import budgets, filters, ordering
from clipquarry import session
from clipquarry.plans import curation, manifest, metrics
from clipquarry.sources.tables import read_table
from workload import fixtures as fx
from workload import queries

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "10000")
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def clips(spark):
    return fx.clips(spark, SF_DIR)


def test_cut_off_reaches_the_scan_before_the_texts_are_tested(clips):
    lifted = filters.category_columns(clips, "proper_noun", ["id", "duration", "transcript"])
    budget = budgets.find_budget(
        lifted, "density", "duration", "t", limit=5_000,
        where=lambda rows: filters.quality_filter(rows, "strict"),
    )
    shown = plan(budget.attach(lifted))
    assert f"categories.proper_noun.density,{budget.lowest}" in shown
    tests = shown[shown.index("Filter ("):]
    assert tests.index("density") < tests.index("RLIKE")


def test_only_the_used_category_fields_are_read(clips):
    lifted = filters.category_columns(clips, "email", ["id"]).select("id", "email_count")
    assert "categories:struct<email:struct<count:bigint>>>" in plan(lifted)


def test_a_budget_orders_totals_not_rows(clips):
    kept = clips.select("id", "duration", F.col("categories.proper_noun.count").alias("n"))
    shown = plan(budgets.running_budget(kept, "n", "duration", limit=5_000))
    rows, totals = shown.split("BroadcastExchange")
    assert "SinglePartition" not in rows and "Window" not in rows


def test_the_row_by_row_budget_is_one_filter(clips):
    kept = clips.select("id", "duration", F.col("categories.proper_noun.count").alias("n"))
    shown = plan(budgets.take_within_budget(kept, "n", "duration", 5_000, ["id"]))
    assert "Exchange" not in shown and "GreaterThanOrEqual(categories.proper_noun.count" in shown


def test_latest_rows_are_picked_before_the_shuffle(spark):
    docs = read_table(spark, f"{SF_DIR}/documents.parquet", ["doc_id", "source"])
    shown = plan(ordering.keep_latest(docs, "source", F.col("doc_id").desc()))
    assert "WindowGroupLimit" in shown[shown.index("Exchange"):]


def test_a_filter_on_tags_does_not_call_the_tagger_twice(clips):
    tagged = metrics.annotate(clips.select("id", "transcript"), lambda: None)
    assert plan(tagged.filter(F.size("tokens") > 3)).count("ArrowEvalPython") == 1


def test_metrics_need_no_shuffle(spark):
    measured = metrics.document_metrics(fx.annotated(spark, SF_DIR), "tagged_words", "human_transcript_text")
    assert "Exchange" not in plan(measured)


def test_curation_reads_the_texts_in_one_scan_before_the_join(clips):
    shown = plan(curation.curate_strict(clips, 5_000))
    schemas = [line for line in shown.splitlines() if "FileScan parquet" in line]
    assert sum("transcript:string" in s for s in schemas) == 1  # the rows that the selection is joined to


def test_stored_metrics_are_pruned(spark):
    kept = curation.select_top_hours(fx.annotated(spark, SF_DIR), "tagged_words", 1).select("raw_filepath")
    (scan,) = [line for line in plan(kept).splitlines() if "FileScan parquet" in line]
    assert "tag_distribution" not in scan[scan.index("ReadSchema"):]


def test_no_temporary_folder_on_a_cluster():
    assert session.is_one_machine("local[4]") and session.is_one_machine("local")
    assert not session.is_one_machine("local-cluster[2,1,1024]") and not session.is_one_machine("spark://h:7077")

    class Context:
        master = "spark://h:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())


def test_destinations_differ(spark):
    paths = ["g/a/x.wav", "g/b/x.wav", "g/c/x.m4a", "g/c/x.wav", "h/x.webm"]
    df = spark.createDataFrame([(p,) for p in paths], "transcoded_filepath string")
    found = [r["destination"] for r in manifest.media_route(df, "out", "set", key="k").collect()]
    assert len(set(found)) == len(paths)
    other = [r["destination"] for r in manifest.media_route(df, "out", "set", key="l").collect()]
    assert not set(found) & set(other)


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["f2_not_document_dump", "x13_skip_existing"])
def test_clips_are_made_without_evidence_that_is_not_read(spark, name):
    assert "regexp_extract_all" not in plan_of(queries.QUERIES[name](spark, SF_DIR))


@pytest.mark.parametrize("name", ["x8_noun_ratio_entities", "x8_noun_ratio_entity_tags", "a10_compare_taggers", "d3_evaluate_words"])
def test_annotations_are_made_where_they_are_read(spark, name):
    assert "Relation [doc_id" in plan_of(queries.QUERIES[name](spark, SF_DIR))


@pytest.mark.parametrize("name", ["u2_tag_set_difference", "x20_derive_tag_mapping"])
def test_tags_are_distinct_before_they_are_rows(spark, name):
    assert plan_of(queries.QUERIES[name](spark, SF_DIR)).count("explode(array_distinct(") == 2


def test_category_tables_read_stored_counts(spark):
    assert "regexp_extract_all" not in plan_of(queries._every_category(spark, SF_DIR))


def test_unmatched_documents_are_joined_without_their_labels(spark):
    tables = spark.createDataFrame([("c", "1", "u1"), ("c", "2", "u2"), ("c", "3", "u3")], "category string, id string, vendor_transcript string")
    labels = spark.createDataFrame([("u1", "text"), ("u2", None)], "uri string, label string")
    found = manifest.vendor_unmatched(tables, labels)
    assert sorted((r["id"], r["reason"]) for r in found.collect()) == [("2", "malformed"), ("3", "missing")]
    joined = plan_of(found).split("Join LeftOuter")[0] + plan_of(found).split("Join ")[1].splitlines()[0]
    assert "label" not in joined

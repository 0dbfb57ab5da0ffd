"""Entity scores: gold against predicted BIO tags.

Gold and prediction of a sentence sit in one row, so spans are found and matched inside the row and
only (type, counts) leave it; the sums combine map-side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipquarry.functions.tags import OUTSIDE, entity_spans

_COUNTS = ("true_positives", "predicted", "support")


def explode_spans(df: DataFrame, tags: str, keep: Sequence[str] = ("sent_id",)) -> DataFrame:
    """One row per entity span: ``type``, ``start``, ``stop``."""
    return df.select(*keep, F.inline(entity_spans(tags)))


def span_counts(
    df: DataFrame, gold: str = "gold", predicted: str = "pred", by: Sequence[str] = ()
) -> DataFrame:
    """Matched, predicted and gold spans per entity type."""
    marked = df.select(*by, entity_spans(gold).alias("_g"), entity_spans(predicted).alias("_p"))
    hit = F.array_intersect("_g", "_p")

    def as_rows(spans: Column | str, column: str) -> Column:
        return F.transform(
            spans,
            lambda s: F.struct(
                s["type"].alias("type"),
                *[F.lit(int(c == column)).cast("long").alias(c) for c in _COUNTS],
            ),
        )

    rows = F.concat(
        as_rows(hit, "true_positives"), as_rows(F.col("_p"), "predicted"), as_rows(F.col("_g"), "support")
    )
    return (
        marked.select(*by, F.inline(rows))
        .groupBy(*by, "type")
        .agg(*[F.sum(c).alias(c) for c in _COUNTS])
    )


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _f1(precision: Column, recall: Column) -> Column:
    return _ratio(2 * precision * recall, precision + recall)


def _scored(counts: DataFrame) -> DataFrame:
    hits, predicted, support = (F.col(c) for c in _COUNTS)
    return (
        counts.withColumn("precision", _ratio(hits, predicted))
        .withColumn("recall", _ratio(hits, support))
        .withColumn("f1", _f1(F.col("precision"), F.col("recall")))
    )


def _micro(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    summed = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _COUNTS]
    return _scored(counts.groupBy(*by).agg(*summed))


def span_scores(
    df: DataFrame, gold: str = "gold", predicted: str = "pred", by: Sequence[str] = ()
) -> DataFrame:
    """Micro precision, recall and F1 over all entities; 0 where undefined."""
    return _micro(span_counts(df, gold, predicted, by), by).select(*by, "precision", "recall", "f1")


def span_report(
    df: DataFrame, gold: str = "gold", predicted: str = "pred", by: Sequence[str] = ()
) -> DataFrame:
    """Precision, recall, F1 and support per entity type, then their micro, macro and
    support-weighted averages. One pass over the sentences; the averages are windows over the few
    rows, one per entity type, that come out of it."""
    scores = ("precision", "recall", "f1")
    group = Window.partitionBy(*by)
    whole = {c: F.sum(c).over(group) for c in _COUNTS}
    precision = _ratio(whole["true_positives"], whole["predicted"])
    recall = _ratio(whole["true_positives"], whole["support"])

    def line(name: Column, values: Sequence[Column], support: Column) -> Column:
        pairs = [v.alias(n) for n, v in zip(scores, values)]
        return F.struct(name.alias("type"), *pairs, support.alias("support"))

    def weighted(c: str) -> Column:
        return _ratio(F.sum(F.col(c) * F.col("support")).over(group), whole["support"])

    report = _scored(span_counts(df, gold, predicted, by)).select(
        *by,
        line(F.col("type"), [F.col(c) for c in scores], F.col("support")).alias("_own"),
        F.row_number().over(group.orderBy("type")).alias("_nth"),
        F.array(
            line(F.lit("micro avg"), [precision, recall, _f1(precision, recall)], whole["support"]),
            line(F.lit("macro avg"), [F.avg(c).over(group) for c in scores], whole["support"]),
            line(F.lit("weighted avg"), [weighted(c) for c in scores], whole["support"]),
        ).alias("_averages"),
    )
    own = F.array("_own")
    lines = F.when(F.col("_nth") == 1, F.concat(own, F.col("_averages"))).otherwise(own)
    return report.select(*by, F.inline(lines))


def compare_taggers(df: DataFrame, model: str = "model") -> DataFrame:
    """Reports of all taggers side by side, in one job rather than one per tagger."""
    return span_report(df, by=[model])


def derive_tag_mapping(model: DataFrame, corpus: DataFrame, tag: str = "tag") -> DataFrame:
    """Each tagger tag with the corpus tag of the same prefix and entity, ``O`` where there is none.
    ``map_tags`` takes the collected pairs: there are as many as the tagger has tags."""
    known = corpus.select(tag).distinct().withColumn("_known", F.lit(True))
    mapped = F.when(F.col("_known"), F.col(tag)).otherwise(OUTSIDE)
    return model.select(tag).distinct().join(known, tag, "left").select(tag, mapped.alias("mapped"))


def tag_set_difference(a: DataFrame, b: DataFrame, tag: str = "tag") -> DataFrame:
    """Tags that only one side has, with the side; no rows when the sets are equal."""
    sides = a.select(tag, F.lit("left").alias("side")).unionByName(
        b.select(tag, F.lit("right").alias("side"))
    )
    return (
        sides.groupBy(tag)
        .agg(F.min("side").alias("side"), F.max("side").alias("_other"))
        .filter(F.col("side") == F.col("_other"))
        .drop("_other")
    )

"""Operator inputs derived from the test tables, row by row, without grouping. The SQL twins build
the same from the same tables (``workload.sql``). Annotations that would come from a model are
stand-ins made by simple rules."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipquarry.functions import text as tx
from clipquarry.functions.columns import let
from clipquarry.session import scratch_path
from clipquarry.sources.tables import read_table, write_table

# Stand-ins where no pattern is given for a category.
PATTERNS = {
    "proper_noun": "[A-Z][a-z]+",
    "address": "[0-9]+ [A-Z][a-z]+",
    "alphanumeric": "[A-Za-z]+[0-9]+|[0-9]+[A-Za-z]+",
    "website": r"https?://[^ \n]+",
}
AUDIO = [".wav", ".flac", ".m4a", ".webm", ".mp3"]
SENTENCE_WORDS = 32
ENTITY_TYPES = ["person", "location", "group"]
ENTITY_LABELS = ["PERSON", "ORG", "GPE", "LOC", "DATE"]


def table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """A test table, read as its files are split."""
    return read_table(spark, f"{sf_dir}/{name}.parquet", columns)


_STORED: dict[tuple[str, str, str], str] = {}


def stored(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Keeps a fixture as a table in the session's shared folder, as annotations are kept in real
    use: it is built by the first query that needs it, and scans can prune and push down."""

    @wraps(build)
    def read(spark: SparkSession, sf_dir: str) -> DataFrame:
        key = (spark.sparkContext.applicationId, sf_dir, build.__name__)
        if key not in _STORED:
            path = scratch_path(spark, build.__name__)
            write_table(build(spark, sf_dir), path)
            _STORED[key] = path
        return read_table(spark, _STORED[key])

    read.derived = build  # the same rows made in the query that reads them, just the columns it needs
    return read


def dealt(df: DataFrame, key: str) -> DataFrame:
    """Rows dealt out by a hash of their key, as a table of any size is stored: an input may be one block of one file,
    which a single task would read and derive everything from."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def _category(evidence: Column, n_words: Column) -> Column:
    count = F.size(evidence).cast("long")
    density = F.when(n_words > 0, count / n_words).otherwise(F.lit(0.0))
    return F.struct(
        density.alias("density"),
        count.alias("count"),
        (count > 0).alias("exists"),
        evidence.alias("evidence"),
    )


@stored
def clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = dealt(table(spark, sf_dir, "documents"), "doc_id")
    doc_id = F.col("doc_id").cast("string")
    ext = F.get(F.array(*[F.lit(e) for e in AUDIO]), (F.col("doc_id") % 5).cast("int"))
    evidence = {c: F.regexp_extract_all("text", F.lit(p), F.lit(0)) for c, p in PATTERNS.items()}
    evidence["email"] = tx.extract_emails("text")
    evidence["phone_number"] = tx.extract_phones("text")
    order = ["proper_noun", "email", "address", "alphanumeric", "phone_number", "website"]
    found = docs.select(
        "*", tx.word_count("text").alias("_n"), *[evidence[c].alias(f"_{c}") for c in order]
    )
    return found.select(
        doc_id.alias("id"),
        F.concat(
            F.lit("gs://bkt/"), "source", F.lit("/clip_"), doc_id, ext
        ).alias("transcoded_filepath"),
        F.col("text").alias("transcript"),
        F.floor(F.col("n_chars") / 15).alias("duration"),
        F.struct(*[_category(F.col(f"_{c}"), F.col("_n")).alias(c) for c in order]).alias("categories"),
    )


def transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several rows per ``channel``; ``raw_filepath`` is unique."""
    return table(spark, sf_dir, "documents").select(
        F.col("source").alias("channel"),
        F.concat(F.lit("gs://raw/"), F.col("doc_id").cast("string")).alias("raw_filepath"),
        F.floor(F.col("n_chars") / 15).alias("duration"),
        F.col("text").alias("human_transcript_text"),
    )


def tag_of(tokens: Column, w: Column, i: Column) -> Column:
    """``B-`` for a capitalised word, ``I-`` right after one; the type depends on the length."""
    kinds = F.array(*[F.lit(t) for t in ENTITY_TYPES])
    kind = F.get(kinds, F.length(w) % len(ENTITY_TYPES))
    name = lambda c: F.coalesce(c.rlike("^[A-Z][a-z]+$"), F.lit(False))
    prefix = F.when(name(F.get(tokens, i - 1)), "I-").otherwise("B-")
    return F.when(name(w), F.concat(prefix, kind)).otherwise("O")


@stored
def annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``transcripts`` with ``entities``, ``tags`` and ``pos``."""
    split = dealt(transcripts(spark, sf_dir), "raw_filepath").withColumn("tokens", tx.words("human_transcript_text"))
    tokens = F.col("tokens")
    labels = F.array(*[F.lit(x) for x in ENTITY_LABELS])
    names = F.regexp_extract_all("human_transcript_text", F.lit("[A-Z][A-Za-z]*"), F.lit(0))
    return split.withColumns(
        {
            "entities": F.transform(
                names,
                lambda n: F.struct(
                    n.alias("text"), F.get(labels, F.length(n) % len(ENTITY_LABELS)).alias("label")
                ),
            ),
            "tags": F.transform(tokens, lambda w, i: tag_of(tokens, w, i)),
            "pos": F.transform(
                tokens, lambda w: F.when(w.rlike("^[A-Z]"), "PROPN").otherwise("NOUN")
            ),
        }
    )


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One timed segment per line of a document."""
    lines = F.split("text", "\n")
    timed = F.transform(
        lines,
        lambda t, i: F.struct(
            (i * 10_000).cast("long").alias("start_ms"),
            (i * 10_000 + F.length(t) * 60).cast("long").alias("end_ms"),
            t.alias("text"),
        ),
    )
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("gs://raw/"), F.col("doc_id").cast("string")).alias("raw_filepath"),
        timed.alias("human_transcript_timestamps"),
    )


def sentence_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments with ``array<struct<text,proper_nouns>>``: comma-separated pieces of a line."""
    pieces = F.split("_s.text", ", ")
    return segments(spark, sf_dir).select(
        "raw_filepath", F.explode("human_transcript_timestamps").alias("_s")
    ).select(
        "raw_filepath",
        "_s.start_ms",
        "_s.end_ms",
        F.transform(
            pieces,
            lambda p: F.struct(
                p.alias("text"), F.regexp_count(p, F.lit("[A-Z][a-z]+")).alias("proper_nouns")
            ),
        ).alias("sentences"),
    )


def pointers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A vendor transcript URI for every labelled document."""
    doc_id = F.col("doc_id").cast("string")
    uri = F.concat(F.lit("gs://bkt/v/"), doc_id, F.lit(".json"))
    return table(spark, sf_dir, "labels").select(doc_id.alias("id"), uri.alias("transcript_gcs_uri"))


@stored
def vendor_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document as vendor JSON, one entry per line; French ones start with a byte order mark."""
    entries = F.transform(
        F.split("text", "\n"),
        lambda line: F.struct(
            F.transform(F.split(line, " "), lambda w: F.struct(w.alias("text"))).alias("words")
        ),
    )
    mark = F.when(F.col("lang") == "fr", "\ufeff").otherwise("")
    doc_id = F.col("doc_id").cast("string")
    return dealt(table(spark, sf_dir, "documents"), "doc_id").select(
        F.concat(F.lit("gs://bkt/v/"), doc_id, F.lit(".json")).alias("uri"),
        F.concat(mark, F.to_json(entries)).alias("document"),
    )


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored objects: the audio of every labelled document."""
    stored = table(spark, sf_dir, "labels", ["doc_id"])
    return (
        clips(spark, sf_dir)
        .join(stored.select(F.col("doc_id").cast("string").alias("id")), "id", "left_semi")
        .select(F.col("transcoded_filepath").alias("path"), F.col("duration").alias("length"))
    )


def _blocks(spark: SparkSession, sf_dir: str, word: str) -> DataFrame:
    """Whole documents as blocks of words: ``sent_id``, ``tokens``."""
    def blocks(words: Column) -> Column:
        last = F.floor((F.size(words) - 1) / SENTENCE_WORDS).cast("int")
        cut = lambda i: F.slice(words, i * SENTENCE_WORDS + 1, F.lit(SENTENCE_WORDS))
        return F.when(F.size(words) > 0, F.transform(F.sequence(F.lit(0), last), cut))

    words = F.regexp_extract_all("text", F.lit(word), F.lit(0))
    cut = dealt(table(spark, sf_dir, "documents", ["doc_id", "text"]), "doc_id").select(
        "doc_id", F.posexplode(let(words, blocks)).alias("_b", "tokens")
    )
    sent_id = F.concat_ws("-", F.col("doc_id").cast("string"), F.col("_b").cast("string"))
    return cut.select(sent_id.alias("sent_id"), "tokens")


def tagged_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``gold`` tags and two models' ``pred``: gold with words of certain lengths missed."""
    tokens = F.col("tokens")
    gold = _blocks(spark, sf_dir, tx.WORD).withColumn(
        "gold", F.transform(tokens, lambda w, i: tag_of(tokens, w, i))
    )
    missed = F.explode(
        F.array(
            F.struct(F.lit("seven").alias("model"), F.lit(7).alias("n")),
            F.struct(F.lit("five").alias("model"), F.lit(5).alias("n")),
        )
    )
    every = gold.withColumn("_m", missed)
    pred = F.zip_with(
        "gold", "tokens", lambda g, w: F.when(F.length(w) % F.col("_m.n") == 0, "O").otherwise(g)
    )
    return every.select(F.col("_m.model").alias("model"), "sent_id", "tokens", "gold", pred.alias("pred"))


def _piece_column(name: str, kind: str) -> Column:
    """A column of ``piece_sentences`` made from ``tokens`` and ``gold``, for all words of a batch at once. Each is a function of its
    own, so that a query makes those it reads; non-deterministic, so that none is made twice."""
    cut = F.arrow_udf(lambda tokens, gold: getattr(PieceCut(tokens, gold), name)(), kind)
    return cut.asNondeterministic()("tokens", "gold").alias(name)


class PieceCut:
    """A batch of words cut into pieces of four letters. Put together, the words and their pieces are the same bytes."""

    def __init__(self, tokens: pa.Array, gold: pa.Array) -> None:
        words, self.gold = tokens.flatten().cast(pa.string()), gold.flatten()
        letters = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        self.counts, self.missed = -(-letters // 4), letters % 7 == 0
        self.word = np.repeat(np.arange(len(words)), self.counts)
        self.nth = np.arange(len(self.word)) - np.repeat(np.cumsum(self.counts) - self.counts, self.counts)
        _, offsets, data = words.buffers()
        stops = np.frombuffer(offsets, np.int32)[words.offset:words.offset + len(words) + 1] if len(words) else np.zeros(1, np.int32)
        self.data = np.frombuffer(data or b"", np.uint8)[stops[0]:stops[-1]]
        first = np.flatnonzero(self.data & 0xC0 != 0x80)  # the first byte of each letter
        self.at = np.append(first[(np.cumsum(letters) - letters)[self.word] + 4 * self.nth], len(self.data)).astype(np.int32)
        self.words = np.append(0, np.cumsum(pc.list_value_length(tokens).to_numpy(zero_copy_only=False)))  # ends of the sentences
        self.ends = np.append(0, np.cumsum(self.counts))[self.words].astype(np.int32)

    def _texts(self) -> pa.Array:
        raw = pa.StringArray.from_buffers(len(self.word), pa.py_buffer(self.at), pa.py_buffer(self.data.copy()))
        return pc.if_else(pa.array(self.nth > 0), pc.binary_join_element_wise("##", raw, ""), raw)

    def _tags(self) -> pa.Array:
        """The word's tag on its first piece and the same within an entity on the others; words of 7, 14, … letters are missed."""
        coded = self.gold.dictionary_encode()
        names = coded.dictionary.to_pylist()
        table = pa.array([*names, *("O" if t == "O" else "I" + t[1:] for t in names), "O"], pa.string())
        code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)[self.word]
        return table.take(pa.array(np.where(self.missed[self.word], 2 * len(names), code + len(names) * (self.nth > 0))))

    def _led(self, values: pa.Array, first: pa.Array) -> pa.Array:
        """Lists of the pieces' values behind one more of their own, the special token's."""
        special = self.ends[:-1] + np.arange(len(self.ends) - 1)
        place = np.ones(len(values) + len(special), bool)
        place[special] = False
        index = np.where(place, np.cumsum(place) - 1, len(values))
        return pa.ListArray.from_arrays(pa.array(self.ends + np.arange(len(self.ends), dtype=np.int32)), pa.concat_arrays([values, first]).take(pa.array(index)))

    def pieces(self) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(self.ends), self._texts())

    def word_ids(self) -> pa.Array:
        inside = np.arange(self.words[-1]) - np.repeat(self.words[:-1], np.diff(self.words))
        return self._led(pa.array(inside[self.word].astype(np.int32)), pa.array([None], pa.int32()))

    def subword_tags(self) -> pa.Array:
        return self._led(self._tags(), pa.array(["O"]))

    def entities(self) -> pa.Array:
        tags = self._tags()
        kept = pc.not_equal(tags, "O").to_numpy(zero_copy_only=False)
        index = np.arange(1, len(self.word) + 1) - np.repeat(self.ends[:-1], np.diff(self.ends))
        columns = [pa.array(index.astype(np.int32)), self._texts(), tags]
        found = pa.StructArray.from_arrays([c.filter(pa.array(kept)) for c in columns], ["index", "word", "entity"])
        return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(kept))[self.ends].astype(np.int32)), found)


def piece_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences cut into sub-word pieces of four letters, with everything a tagger gives for them:
    ``pieces``, ``word_ids`` and ``subword_tags`` (one leading special token), sparse ``entities``."""
    tokens = F.col("tokens")
    base = _blocks(spark, sf_dir, f"(?U)[^{tx.BLANK}#Ġ]+").withColumn(
        "gold", F.transform(tokens, lambda w, i: tag_of(tokens, w, i))
    )
    return base.select(
        "sent_id",
        "tokens",
        "gold",
        _piece_column("pieces", "array<string>"),
        _piece_column("word_ids", "array<int>"),
        _piece_column("subword_tags", "array<string>"),
        _piece_column("entities", "array<struct<index:int,word:string,entity:string>>"),
    )


STORED_FIXTURES = [clips, annotated, vendor_documents]

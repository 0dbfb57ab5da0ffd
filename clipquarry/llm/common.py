"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clipquarry.session import scratch_path

BROADCAST_ROWS = 10_000
SPARE = 1.5  # times the rows that are wanted of a label: what is ranked
WORKER_CACHE = 400_000  # entries of a per-process memo; it is emptied when full


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def store(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` once to the shared folder and reads it back: lineage is cut, lost executors
    cost nothing, and later scans prune columns."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name`` with as many underscores as it takes to clash with no column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A stored table of narrow rows, marked for broadcast only after counting it. A larger one is
    joined by shuffling, where AQE splits skewed keys."""
    return F.broadcast(df) if df.count() <= rows else df


def spread(files: DataFrame, name: str) -> DataFrame:
    """A stored list of files, dealt out so that every core gets some: by its bytes it would be one task."""
    cores = files.sparkSession.sparkContext.defaultParallelism
    return files.repartition(max(1, min(files.count(), 4 * cores)), name)


def released(run):
    """A map over Arrow batches that gives the memory of its batches back to the system when it is done, so that a worker that
    waits for its next task, or runs one of another stage, does not hold it."""

    @wraps(run)
    def wrapped(batches):
        import pyarrow as pa

        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()

    return wrapped


def held_out(doc_id: str) -> Column:
    """The fold that is never learned from: crc32 of the id as text, modulo 3, is 1. Null ids are not in it."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, rows_per_label: int, *, doc_id: str, label: str, text: str = "text"
) -> DataFrame:
    """``label`` and ``text`` of at most ``rows_per_label`` documents of each label: those whose hashed ids are the
    smallest. Ids are chosen from ``labels`` alone, so the texts are joined with a bounded list; the cut
    is made again behind the join, in case one id stands on many rows. Null ids and null labels take no part;
    an id with several labels has its largest.

    Labels are few keys with any number of rows, so rows are ranked only after a bound on their hash, read off the number of
    rows of a label, has left about ``SPARE`` times as many as are wanted, however many there were."""
    known = labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull())
    one = known.groupBy(F.col(doc_id).alias("_i")).agg(F.max(label).cast("int").alias("label"))
    one = store(one.withColumn("_h", F.xxhash64("_i")), "labelled_ids")
    by_hash = Window.partitionBy("label").orderBy("_h", "_i")
    few = _smallest(one, one, rows_per_label)
    ids = store(few.withColumn("_r", F.row_number().over(by_hash)).where(F.col("_r") <= rows_per_label), "sample_ids")
    texts = docs.select(F.col(doc_id).alias("_d"), F.col(text).alias("text"))
    picked = F.broadcast(ids.select("_i", "label"))  # at most rows_per_label rows of each label
    joined = texts.join(picked, F.col("_d") == F.col("_i"))
    # rows of one id are told apart by their place, so that no group of copies is kept or dropped whole
    joined = joined.withColumn("_h", F.xxhash64("_d", "text", F.monotonically_increasing_id()))
    counted = docs.select(F.col(doc_id).alias("_d")).join(picked, F.col("_d") == F.col("_i"))
    again = Window.partitionBy("label").orderBy(F.xxhash64("_d"), "_d", F.xxhash64("text"))
    rows = _smallest(joined, counted, rows_per_label).withColumn("_r", F.row_number().over(again))
    return rows.where(F.col("_r") <= rows_per_label).select("label", "text")


def _smallest(rows: DataFrame, counted: DataFrame, most: int) -> DataFrame:
    """The rows whose hash ``_h`` is among the smallest of their label, about ``SPARE`` times ``most`` of them, or all where there
    are fewer. ``counted`` has as many rows of each label."""
    shares = counted.groupBy("label").agg(F.least(F.lit(1.0), F.lit(SPARE * most) / F.count("*")).alias("_share"))
    shares = F.broadcast(store(shares, "label_shares"))  # one row per label
    # a share of the range of hashes, from the smallest on
    bound = F.col("_share") * F.lit(2.0**64) - F.lit(2.0**63)
    return rows.join(shares, "label").where((F.col("_share") == 1) | (F.col("_h") < bound)).drop("_share")


def trained(sample: DataFrame, fit) -> bytes:
    """What ``fit`` makes of the rows of a bounded sample, in one task. ``fit`` takes an iterator of record batches
    and returns bytes; they are the model, whose size the operator bounds."""

    def run(batches):
        import pyarrow as pa

        yield pa.RecordBatch.from_arrays([pa.array([fit(batches)], pa.binary())], ["model"])

    one_task = sample.repartition(1).sortWithinPartitions("label", F.xxhash64("text"))
    row = one_task.mapInArrow(run, "model binary").first()
    return bytes(row["model"]) if row else fit(iter([]))  # an empty sample has no task

"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

BATCH_ONLY = "{} needs the whole table; it cannot run on a streaming DataFrame"


def build_session(app: str = "clipquarry", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators count on. AQE splits skewed join partitions and
    picks broadcasts from measured sizes; everything else is left to the cluster's own defaults."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``. Only where none is set and the master is local (tests, one
    machine) a temporary folder is made the checkpoint folder; on a cluster executors would each write
    to a disk of their own, so there it is an error."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not named and not is_one_machine(spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = named or tempfile.mkdtemp(prefix="clipquarry-")
        spark.sparkContext.setCheckpointDir(named)
    return named or current


def is_one_machine(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/scratch-{uuid.uuid4().hex}/{name}"


def freeze(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and store it as Parquet in the shared folder, so that later passes read the same
    rows, even when executors are lost, and just the columns they need."""
    path = scratch_path(df.sparkSession, "frozen")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def require_batch(df: DataFrame, operator: str) -> None:
    if df.isStreaming:
        raise ValueError(BATCH_ONLY.format(operator))

"""Tables kept as versions of a list of live files, so that an update rewrites only the files it touches.

Below the table's folder, ``data`` holds Parquet files that never change, and ``versions/version=N`` one Parquet file with a
row per live file: its path, rows, smallest and largest key, and the table's schema. A version exists once this one file
has been committed, by a rename, so readers see the old table or the new one and nothing between; files of a failed
update belong to no version and are never read. Versions only grow, and two writers of one version collide."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipquarry.operators.joins import merge_update, thinned
from clipquarry.session import freeze, require_batch
from clipquarry.sources.files import decoded

_FILE = "_file"


def _path() -> Column:
    return decoded("_metadata.file_path")


def _versions(folder: str) -> str:
    return f"{folder.rstrip('/')}/versions"


def current_version(spark: SparkSession, folder: str) -> int:
    return spark.read.parquet(_versions(folder)).agg(F.max("version")).first()[0]


def live_files(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """``file``, ``rows``, ``least``, ``most`` (keys as text) and ``schema`` of the files of a version, the last by default."""
    version = current_version(spark, folder) if version is None else version
    return spark.read.parquet(f"{_versions(folder)}/version={version}")


def read_version(spark: SparkSession, folder: str, version: int | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """The table as of a version. Columns that were added later are null in files from before."""
    files = live_files(spark, folder, version).select("file", "schema").collect()
    return _read(spark, files, columns)


def _read(spark: SparkSession, files: Sequence[T.Row], columns: Sequence[str] | None = None) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(files[0]["schema"]))
    paths = [f["file"] for f in files if f["file"] is not None]
    df = spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
    return df if columns is None else df.select(*columns)


def _written(df: DataFrame, folder: str, key: str) -> DataFrame:
    """Writes ``df`` as new files; a row of the list for each of them that holds rows."""
    target = f"{folder.rstrip('/')}/data/{uuid.uuid4().hex}"
    df.write.parquet(target)
    text = F.col(key).cast("string")
    rows = df.sparkSession.read.schema(df.schema).parquet(target).select(_path().alias("file"), text.alias("k"))
    return rows.groupBy("file").agg(F.count("*").alias("rows"), F.min("k").alias("least"), F.max("k").alias("most"))


def _commit(listed: DataFrame, schema: T.StructType, folder: str, version: int) -> None:
    """One file, hence one rename, makes the version; an empty table has a row without a file."""
    spark, text = listed.sparkSession, schema.json()
    none = spark.createDataFrame([(None, 0, None, None)], "file string, rows long, least string, most string")
    rows = freeze(listed)
    rows = rows if rows.count() else none
    rows.withColumn("schema", F.lit(text)).coalesce(1).write.mode("errorifexists").parquet(f"{_versions(folder)}/version={version}")


def create_versioned(df: DataFrame, folder: str, key: str) -> DataFrame:
    """Stores ``df`` as the first version of a table. Files with narrow ranges of keys make updates cheaper: sort or
    range-partition by the key before, where updates come by ranges of it."""
    require_batch(df, "create_versioned")
    _commit(_written(df, folder, key), df.schema, folder, 1)
    return read_version(df.sparkSession, folder)


def touched_files(spark: SparkSession, folder: str, source: DataFrame, key: str) -> DataFrame:
    """The live files (rows of the list) that hold a key of ``source``. Files whose range of keys lies outside those of the
    source are left out by the list alone; of the others only the key column is read."""
    keys = freeze(source.select(F.col(key).cast("string").alias(key)).filter(F.col(key).isNotNull()).distinct())
    span = keys.agg(F.min(key).alias("least"), F.max(key).alias("most")).first()
    listed = live_files(spark, folder)
    reach = listed.filter((F.col("least") <= F.lit(span["most"])) & (F.col("most") >= F.lit(span["least"])))
    candidates = reach.filter(F.col("file").isNotNull()).select("file", "schema").collect()
    if not candidates:
        return listed.filter(F.lit(False))
    rows = _read(spark, candidates).select(F.col(key).cast("string").alias(key), _path().alias(_FILE))
    hit = thinned(rows, keys, key).join(keys, key, "left_semi").select(F.col(_FILE).alias("file")).distinct()
    return listed.join(F.broadcast(freeze(hit)), "file", "left_semi")  # one row per file


def merge_versioned(spark: SparkSession, folder: str, source: DataFrame, key: str, updates: dict[str, str]) -> DataFrame:
    """:func:`merge_update` of a stored table: target columns set from source columns on equal keys, added as null where the
    table lacks them. Only files that hold a matched key are read whole and written anew; the others stay in the list as they
    are. A target row matched by several source rows fails, and the table stays at its version. Returns the table as
    updated; without a match no version is made."""
    version = current_version(spark, folder)
    listed = live_files(spark, folder, version)
    schema = read_version(spark, folder, version).schema
    stored = freeze(source.select(key, *dict.fromkeys(updates.values())))
    touched = freeze(touched_files(spark, folder, stored, key))
    files = touched.select("file", "schema").collect()
    if not files:
        return read_version(spark, folder, version)
    merged = merge_update(_read(spark, files), stored, key, updates)
    names = [*schema.names, *[c for c in updates if c not in schema.names]]
    merged = merged.select(*names)
    kinds = {f.name: f for f in [*merged.schema.fields, *schema.fields]}
    whole = T.StructType([T.StructField(n, kinds[n].dataType, True) for n in names])
    fresh = _written(merged, folder, key)
    kept = listed.drop("schema").join(F.broadcast(touched.select("file")), "file", "left_anti")
    _commit(kept.unionByName(fresh), whole, folder, version + 1)
    return read_version(spark, folder, version + 1)

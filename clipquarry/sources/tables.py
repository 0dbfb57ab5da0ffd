"""Tables: scans, existence, schemas, labelled sentences, and writes."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipquarry.functions.tags import tag_names


def read_table(
    spark: SparkSession, source: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """A Parquet path or, without a slash, a catalog table; all columns unless some are named."""
    df = spark.read.parquet(source) if "/" in source else spark.table(source)
    return df if columns is None else df.select(*columns)


def describe_schema(df: DataFrame) -> DataFrame:
    """Field name and type, nested fields with dotted names."""

    def walk(fields: list[T.StructField], prefix: str) -> Iterator[tuple[str, str]]:
        for field in fields:
            name, kind = prefix + field.name, field.dataType
            yield name, kind.simpleString()
            inner = kind.elementType if isinstance(kind, T.ArrayType) else kind
            if isinstance(inner, T.StructType):
                yield from walk(inner.fields, f"{name}.")

    return df.sparkSession.createDataFrame(
        list(walk(df.schema.fields, "")), "field string, type string"
    )


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def load_results(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """JSON records. Give a schema for large inputs: inferring one reads them twice."""
    return (spark.read.schema(schema) if schema is not None else spark.read).json(path)


def read_labelled_sentences(
    spark: SparkSession, source: str, names: list[str], tags: str = "ner_tags"
) -> DataFrame:
    """A token/tag corpus with its integer tags replaced by their names."""
    return read_table(spark, source).withColumn(tags, tag_names(tags, names))


def write_table(
    df: DataFrame,
    target: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Writes to a Parquet path or a catalog table and returns it as read back. ``overwrite``
    replaces, ``ignore`` keeps what is there, ``recreate`` drops a catalog table first."""
    spark = df.sparkSession
    if mode == "recreate":
        mode = "overwrite"
        if "/" not in target:
            spark.sql(f"DROP TABLE IF EXISTS {target}")
    if mode == "ignore" and "/" not in target and table_exists(spark, target):
        return read_table(spark, target)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if "/" in target:
        writer.parquet(target)
    else:
        writer.saveAsTable(target)
    return read_table(spark, target)


def write_json(df: DataFrame, path: str, fields: Sequence[str] | None = None) -> None:
    """JSON records with only the listed fields that exist."""
    kept = df if fields is None else df.select(*[f for f in fields if f in df.columns])
    kept.write.mode("overwrite").json(path)


def write_stats_log(lines: DataFrame, path: str) -> None:
    """``key: value`` lines."""
    lines.select(F.concat(F.col("key"), F.lit(": "), F.col("value")).alias("value")).write.mode(
        "overwrite"
    ).text(path)

"""Reading and writing tables, splits and fitted models."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(spark: SparkSession, base: str, name: str, suffix: str = "") -> DataFrame:
    """Scan ``base/name+suffix``; ``name`` may be a glob such as ``weather/*``."""
    return spark.read.parquet(f"{base.rstrip('/')}/{name}{suffix}")


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    sep: str = ",",
    header: bool = False,
) -> DataFrame:
    """Scan delimited text. Without a schema every column is a string."""
    reader = spark.read.option("sep", sep).option("header", header)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def stage(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write a stage, replacing what was there, and read it back.

    Later steps start from the written files, so nothing upstream runs again.
    The rebalance hint lets AQE split a hot partition value over many files.
    """
    if partition_by:
        writer = df.hint("rebalance", *partition_by).write.partitionBy(*partition_by)
    else:
        writer = df.write
    writer.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(_stored_schema(df, partition_by)).parquet(path)


def stage_bucketed(df: DataFrame, path: str, name: str, keys: list[str], buckets: int) -> DataFrame:
    """Write a stage in buckets sorted by ``keys``, as table ``name`` of the session's catalog with its files at ``path``.

    Tables with equally many buckets on equal keys join without moving either. Rows are
    brought to their bucket once, so a bucket is one file; a key is never split, so stage
    keys this way only if no key holds a large share of the rows. An older table of that name goes.
    """
    placed = df.repartition(buckets, *keys)
    writer = placed.write.mode("overwrite").format("parquet").option("path", path)
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return df.sparkSession.table(name)


def _stored_schema(df: DataFrame, partition_by: list[str] | None) -> T.StructType:
    tail = list(partition_by or [])
    kept = [f for f in df.schema.fields if f.name not in tail]
    return T.StructType(kept + [df.schema[c] for c in tail])


def save_split(df: DataFrame, path: str) -> DataFrame:
    """Write a train / test / prediction table; fail if it is already there."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)


def save_model(model: Pipeline | PipelineModel, path: str) -> None:
    """Save an unfitted pipeline or a fitted one."""
    model.write().save(path)


def load_model(path: str, fitted: bool = True) -> Pipeline | PipelineModel:
    return (PipelineModel if fitted else Pipeline).load(path)

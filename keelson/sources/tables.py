"""Parquet tables, report tables and JSON documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str, key: str | None = None, time: str | None = None,
                partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Write Parquet, rows of a key together and sorted, so that key filters skip row groups.

    ``rebalance`` lets adaptive execution split a key that is too large for one file and join small leftovers.
    """
    out = df
    if key:
        out = df.hint("rebalance", F.col(key)).sortWithinPartitions(key, *([time] if time else []))
    out.write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, sort: Sequence[str] = (), path: str | None = None) -> None:
    """Save a table of unique keys bucketed by key: joins and lookups on the key then need no shuffle of it."""
    writer = df.repartition(buckets, F.col(key)).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key, *sort)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def write_csv_report(df: DataFrame, path: str) -> None:
    """A report table as one CSV file. Reports are aggregates of catalog size; do not use it for data."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def read_csv_report(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)


def write_json_document(df: DataFrame, path: str) -> None:
    """A one-row nested frame as one JSON document."""
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_json_document(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def as_document(df: DataFrame, name: str = "document") -> DataFrame:
    """Every row as JSON text."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias(name))


def first_rows(df: DataFrame, order: Sequence[str], n: int = 25) -> DataFrame:
    """The first rows in a given order, for samples; top-n per task, never a full sort."""
    return df.orderBy(*order).limit(n)

"""Managed tables, bucketed tables and temporary views."""

from __future__ import annotations

from pyspark.sql import DataFrame


def replace_table(df: DataFrame, name: str, path: str | None = None, partition_by: str | None = None) -> None:
    """Drop the table if it exists and create it anew from ``df``."""
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def replace_bucketed(df: DataFrame, name: str, by: str, order: str, buckets: int, path: str | None = None) -> None:
    """Drop the table and create it anew, bucketed by ``by`` and sorted by it and ``order`` inside each bucket.

    What groups, joins or opens windows by ``by`` later needs no exchange. Every bucket is written as one file by
    one task, which sorts with spilling; a key with very many rows makes its bucket's file large.
    """
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    writer = df.repartition(buckets, by).write.mode("overwrite").bucketBy(buckets, by).sortBy(by, order)
    (writer.option("path", path) if path else writer).saveAsTable(name)


def register_views(**tables: DataFrame) -> None:
    """Make DataFrames available to SQL under their argument names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)

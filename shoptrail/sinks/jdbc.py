"""Appending batch results to a JDBC table."""

from __future__ import annotations

from pyspark.sql import DataFrame


def jdbc_options(
    url: str, table: str, user: str | None = None, password: str | None = None, connections: int = 10
) -> dict[str, str]:
    """Writer options; ``connections`` bounds how many tasks write at the same time."""
    options = {
        "url": url,
        "dbtable": table,
        "user": user,
        "password": password,
        "numPartitions": str(connections),
    }
    return {name: value for name, value in options.items() if value is not None}


def append_jdbc(df: DataFrame, url: str, table: str, **options) -> None:
    df.write.format("jdbc").options(**jdbc_options(url, table, **options)).mode("append").save()

"""Reading result tables back over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    split_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    splits: int = 1,
) -> DataFrame:
    """A JDBC table. With ``split_column`` and bounds the read runs in ``splits`` tasks.

    A JDBC relation is queried again by every micro-batch that joins it, so a table read this way
    (the blacklist, say) is always current inside a stream.
    """
    options = {"url": url, "dbtable": table, "user": user, "password": password}
    if split_column:
        options |= {
            "partitionColumn": split_column,
            "lowerBound": lower,
            "upperBound": upper,
            "numPartitions": splits,
        }
    return spark.read.format("jdbc").options(**{k: v for k, v in options.items() if v is not None}).load()

"""Top rows of each group, safe for groups of any size, and broadcasts of bounded results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Up to this k Spark trims each group inside every task before the shuffle
# (spark.sql.optimizer.windowGroupLimitThreshold); beyond it the trimming is done here.
_TRIMMED_BY_SPARK = 1000
_SALTS = 256

# Rows that a broadcast may have at most.
BROADCAST_ROWS = 100_000


def broadcast_up_to(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast ``df``, which has at most ``rows`` rows, unless that is too many; then Spark chooses."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def top_per_group(
    df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str = "rank"
) -> DataFrame:
    """The first ``k`` rows of each group in ``order`` with their row number as ``rank``.

    ``order`` must be total (end in a unique column), else ties are cut at random. No task sorts a
    whole group: each one first keeps the best ``k`` of its own share, so at most ``k`` rows per
    group and task (or salt) meet in the final sort.
    """
    if k > _TRIMMED_BY_SPARK:
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(_SALTS)))
        share = Window.partitionBy(*keys, "_salt").orderBy(*order)
        df = salted.withColumn(rank, F.row_number().over(share)).where(F.col(rank) <= k).drop("_salt", rank)
    group = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(group)).where(F.col(rank) <= k)

"""Next and previous row inside a group, safe for groups of any size.

A plain ``lead`` sorts each group in one task. That is right for ordinary sessions, but one session
(a crawler, a client that never resets its id) may hold a large part of all rows. Such groups are
found by counting, cut into ordered pieces by range partitioning, and the piece ends are joined
in a second, tiny window. The result is the same, row for row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A group of so many rows is cut up.
HOT_ROWS = 1_000_000


def frequent_keys(df: DataFrame, key: str, at_least: int = HOT_ROWS) -> DataFrame:
    """Keys of ``at_least`` rows or more.

    Rows are counted inside the tasks before the shuffle, so a key of any size arrives as one row per
    task. The result is exact: both branches that ask for it get the same keys.
    """
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") >= at_least).select(key)


def _matches(df: DataFrame, frequent: DataFrame, key: str, how: str) -> DataFrame:
    other = frequent.withColumnRenamed(key, "_frequent")
    return df.join(other, F.col(key).eqNullSafe(F.col("_frequent")), how)


def add_neighbour(
    df: DataFrame,
    key: str,
    order: list[str],
    columns: dict[str, str],
    step: int,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Add columns of the next (``step=1``) or previous (``step=-1``) row of the same ``key``.

    ``columns`` maps a source column to the name of the added one; ``order`` must be total within a
    key. When no key is frequent, adaptive execution drops the second branch before it starts. With
    ``hot_rows=None`` no key is looked for: right where ``frequent_keys`` has found none, as in a table bucketed by
    the key, whose rows then need no exchange.
    """
    shift = F.lead if step > 0 else F.lag
    if hot_rows is None:
        whole = Window.partitionBy(key).orderBy(*order)
        return df.withColumns({out: shift(source).over(whole) for source, out in columns.items()})
    frequent = frequent_keys(df, key, hot_rows)

    whole = Window.partitionBy(key).orderBy(*order)
    ordinary = _matches(df, frequent, key, "left_anti").withColumns(
        {out: shift(source).over(whole) for source, out in columns.items()}
    )

    pieces = _matches(df, frequent, key, "left_semi").repartitionByRange(key, *order)
    pieces = pieces.withColumn("_piece", F.spark_partition_id())
    inside = Window.partitionBy(key, "_piece").orderBy(*order)
    pieces = pieces.withColumns(
        {out: shift(source).over(inside) for source, out in columns.items()}
        | {
            "_first": F.lag(F.lit(True)).over(inside).isNull(),
            "_last": F.lead(F.lit(True)).over(inside).isNull(),
        }
    )
    # Only piece ends share a partition (two rows per piece); other rows stay with their piece.
    at_end = F.col("_first") | F.col("_last")
    ends = Window.partitionBy(key, F.when(~at_end, F.col("_piece"))).orderBy("_piece", *order)
    lacks = F.col("_last") if step > 0 else F.col("_first")

    def joined(source: str, out: str) -> Column:
        return F.when(lacks, shift(source).over(ends)).otherwise(F.col(out))

    cut = pieces.withColumns({out: joined(source, out) for source, out in columns.items()})
    return ordinary.unionByName(cut.drop("_piece", "_first", "_last"))


def first_action_key(actions: DataFrame) -> Column:
    """Time order with tie-break as one number, for ``min_by``: microseconds, then ``event_id`` (or the user).

    A struct would order by both columns too, but aggregates on structs are sorted instead of hashed,
    which takes half as long again. A decimal of 38 digits holds both numbers in full; a missing
    id comes first.
    """
    whole = "decimal(38,0)"
    tie = F.col("event_id" if "event_id" in actions.columns else "user_id").cast("decimal(20,0)")
    micros = F.unix_micros(F.col("action_time").cast("timestamp")).cast("decimal(17,0)")
    place = F.coalesce(tie + F.lit(str(2**63)).cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return (micros * F.lit(str(2**64)).cast("decimal(20,0)")).cast(whole) + place.cast(whole)


def action_order(actions: DataFrame) -> list[str]:
    """Time order of actions with a tie-break: ``event_id`` if there is one, else the page."""
    return ["action_time", "event_id"] if "event_id" in actions.columns else ["action_time", "page_id"]

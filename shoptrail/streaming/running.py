"""Running statistics of an ad click stream without state: totals, top ads, trend, sliding hour.

Counts add up, so every batch adds its own counts to a keyed table (see ``sinks.keyed``). No state is
kept in the query, so there is no watermark and no click is ever too late; ``streaming.stateful`` has the
same statistics with Spark's state. Clicks are counted per minute before they are put into sliding windows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shoptrail.fixed_values import TRIGGER_SECONDS
from shoptrail.functions.times import format_time
from shoptrail.operators.ads import city_totals, province_top_ads
from shoptrail.sinks.keyed import KeyedTable
from shoptrail.storage import claim


def sliding_hours(trend: DataFrame, minutes: int = 60) -> DataFrame:
    """Clicks per ad in each window of ``minutes`` that moves on by one, from clicks per minute and ad."""
    at = F.to_timestamp(F.concat("date", "hour", "minute"), "yyyyMMddHHmm")
    start = F.explode(F.transform(F.sequence(F.lit(0), F.lit(minutes - 1)), lambda i: at - F.make_interval(mins=i)))
    windows = trend.select(start.alias("start"), "adid", "clickCount").groupBy("start", "adid").agg(F.sum("clickCount").alias("clickCount"))
    return windows.select(
        format_time("start").alias("windowStart"), format_time(F.col("start") + F.make_interval(mins=F.lit(minutes))).alias("windowEnd"), "adid", "clickCount"
    )


def start_counts(
    clicks: DataFrame, count: Callable[[DataFrame], DataFrame], table: KeyedTable, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Add ``count`` of each batch of clicks to a keyed table with the ``add`` rule."""
    return _start(clicks, lambda batch, name: table.apply(count(batch), name), table, checkpoint, trigger)


def start_province_top_ads(
    clicks: DataFrame, totals: KeyedTable, top: KeyedTable, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Keep city totals, and the top ads of every day and province that a batch touches.

    A ranking needs all ads of a province, so each batch ranks the totals table again, restricted
    to the days and provinces it changed.
    """

    def write(batch: DataFrame, name: str) -> None:
        counts = city_totals(batch).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            totals.apply(counts, name)
            rank_touched(counts, totals, top, name)
        finally:
            counts.unpersist()

    return _start(clicks, write, totals, checkpoint, trigger)


def rank_touched(counts: DataFrame, totals: KeyedTable, top: KeyedTable, batch: int | str) -> None:
    """Replace the top ads of the days and provinces of ``counts``, which ``totals`` has taken in."""
    top.apply(province_top_ads(totals.sharing(counts, ["date", "province"])), batch)


def _start(clicks: DataFrame, write, table: KeyedTable, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    name = claim(table.spark, table.path, checkpoint)
    return (
        clicks.writeStream.option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": f"{TRIGGER_SECONDS} seconds"}))
        .foreachBatch(lambda batch, batch_id: write(batch, f"{name}-{batch_id}"))
        .start()
    )

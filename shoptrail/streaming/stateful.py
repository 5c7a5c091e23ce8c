"""Running statistics of an ad click stream kept in Spark's state store.

* ``running_totals``: clicks per day, province, city and ad, as update-mode state. A day's state goes once the watermark has passed it.
* ``minute_counts`` and ``sliding_hours``: event-time windows in append mode. Clicks are counted per minute first, and only these
  counts are put into the sixty windows that hold their minute.
* ``ban_users``: one stateful processor per user, with the user's counts per day and ad as one value. A ban is emitted once; a timer
  deletes the counts of days that the watermark has passed.

State lives in RocksDB, so it is bounded by disk and not by memory, and each batch writes only what it changed
(changelog checkpoints). A query started again with its checkpoint goes on from the last batch that was committed.
Clicks that come after the watermark are dropped; ``late_rows`` counts them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from shoptrail.fixed_values import BAN_ABOVE_CLICKS, TRIGGER_SECONDS
from shoptrail.functions.times import day_key, format_time, minute_key

#: How much later than the newest click a click may come.
DELAY = "1 hour"
_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
_DAY_MS = 24 * 3600 * 1000


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """Queries started inside use RocksDB with changelog checkpoints; the session's own settings come back."""
    before = {key: spark.conf.get(key, None) for key in _STORE}
    for key, value in _STORE.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def running_totals(clicks: DataFrame, delay: str = DELAY) -> DataFrame:
    """Totals per day, province, city and ad: in update mode, each batch's changed totals.

    The day is a window of event time, so its state falls once the watermark has passed its end.
    """
    day = F.window("ts", "1 day").alias("day")
    counted = clicks.withWatermark("ts", delay).groupBy(day, "province", "city", "adid").agg(F.count(F.lit(1)).alias("clickCount"))
    return counted.select(day_key(F.col("day.start")).alias("date"), "province", "city", "adid", "clickCount")


def _minutes(clicks: DataFrame, delay: str) -> DataFrame:
    return clicks.withWatermark("ts", delay).groupBy(F.window("ts", "1 minute").alias("minute_window"), "adid").agg(F.count(F.lit(1)).alias("clicks"))


def minute_counts(clicks: DataFrame, delay: str = DELAY) -> DataFrame:
    """Clicks per minute and ad: in append mode, each minute once the watermark has passed it."""
    key = minute_key(F.col("minute_window.start"))
    return _minutes(clicks, delay).select(
        F.substring(key, 1, 8).alias("date"), F.substring(key, 9, 2).alias("hour"), F.substring(key, 11, 2).alias("minute"), "adid", F.col("clicks").alias("clickCount")
    )


def sliding_hours(clicks: DataFrame, delay: str = DELAY, length: str = "60 minutes", slide: str = "1 minute") -> DataFrame:
    """Clicks per ad in each hour that begins with a minute: in append mode, each window once the watermark has passed its end.

    Two windowed aggregations follow each other in one query: the sliding windows sum counts of minutes.
    """
    per_minute = _minutes(clicks, delay)
    window = F.window(F.window_time("minute_window"), length, slide).alias("hour_window")
    hours = per_minute.groupBy(window, "adid").agg(F.sum("clicks").alias("clickCount"))
    return hours.select(format_time(F.col("hour_window.start")).alias("windowStart"), format_time(F.col("hour_window.end")).alias("windowEnd"), "adid", "clickCount")


class _Bans(StatefulProcessor):
    """Counts one user's clicks per day and ad until one count is above the limit.

    Each call to the state is a message between Python and the JVM, so what is known of a user is one value, read and
    written once a batch, and one timer waits for the end of the first day in it.
    """

    def __init__(self, above: int):
        self.above = above

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # the day of the ban, or the clicks so far, least day first
        self.user = handle.getValueState("user", "banned long, counts array<struct<day: long, adid: long, clicks: long>>")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = self.user.get()
        if held and held[0] is not None:
            for _ in rows:  # a banned user's clicks count no more
                pass
            return
        before = held[1] if held else []
        counts = {(day, ad): clicks for day, ad, clicks in before}
        new = set()
        for row in rows:
            place = row["day"], row["adid"]
            counts[place] = counts.get(place, 0) + row["clicks"]
            new.add(place)
        over = min((place for place in new if counts[place] > self.above), default=None)
        if over:
            self._wait(before, [])
            self.user.update((over[0], None))
            yield Row(userid=key[0], adid=over[1], clickCount=counts[over])
        else:
            self._keep(before, sorted((*place, clicks) for place, clicks in counts.items()))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        """The days that ended by the watermark can change no more."""
        held = self.user.get()
        if held and held[0] is None:
            ended = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs()) // _DAY_MS
            # the timer that expired is gone by itself
            self._keep([], [tuple(c) for c in held[1] if c[0] >= ended])
        yield from ()

    def _keep(self, before: list, counts: list[tuple[int, int, int]]) -> None:
        self._wait(before, counts)
        if counts:
            self.user.update((None, counts))
        else:
            self.user.clear()

    def _wait(self, before: list, counts: list) -> None:
        """Moves the timer from the end of the first day of ``before`` to that of ``counts``."""
        old, new = ((some[0][0] + 1) * _DAY_MS if some else None for some in (before, counts))
        if old == new:
            return
        if old is not None:
            self.handle.deleteTimer(old)
        if new is not None:
            self.handle.registerTimer(new)

    def close(self) -> None:
        pass


def _combined(clicks: DataFrame) -> DataFrame:
    """Clicks counted per user, day and ad inside each task's batches: a user of any number of clicks is shuffled as few rows."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for some in batches:
            counted = some.groupby(["userid", "day", "adid"], as_index=False).agg(ts=("ts", "max"), clicks=("ts", "size"))
            yield counted[["userid", "day", "adid", "ts", "clicks"]]

    day = F.floor(F.unix_millis(F.col("ts")) / _DAY_MS).alias("day")
    return clicks.select("userid", day, "adid", "ts").mapInPandas(count, "userid long, day long, adid long, ts timestamp, clicks long")


def ban_users(clicks: DataFrame, above: int = BAN_ABOVE_CLICKS, delay: str = DELAY) -> DataFrame:
    """Users with more than ``above`` clicks on one ad on one day, each once, in the batch that brings the count above it.

    State is kept per user only: counts of the days not yet passed by the watermark, or the day of the ban.
    A batch counts whole, so a ban holds from the next one on.
    """
    counted = _combined(clicks).withWatermark("ts", delay)
    return counted.groupBy("userid").transformWithState(_Bans(above), "userid long, adid long, clickCount long", "Update", "EventTime")


def start(
    result: DataFrame, mode: str, checkpoint: str, write: Callable[[DataFrame, int], None], trigger: dict | None = None
) -> StreamingQuery:
    """Start a query on one of the results above; ``write`` gets each batch's rows and number, and may get a batch again."""
    with state_store(result.sparkSession):
        return (
            result.writeStream.outputMode(mode)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": f"{TRIGGER_SECONDS} seconds"}))
            .foreachBatch(write)
            .start()
        )


def state_rows(query: StreamingQuery) -> list[int]:
    """Rows in state after each batch, all operators together."""
    return [sum(o["numRowsTotal"] for o in p["stateOperators"]) for p in query.recentProgress]


def late_rows(query: StreamingQuery) -> int:
    """Rows that came after the watermark and were dropped, over the query's recent batches."""
    return sum(o["numRowsDroppedByWatermark"] for p in query.recentProgress for o in p["stateOperators"])

"""Advertising analytics on parsed clicks ``ts, province, city, userid, adid``.

The same functions serve a whole table and one micro-batch of a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoptrail.fixed_values import BAN_ABOVE_CLICKS, TOP_ADS
from shoptrail.functions.times import day_key, minute_key
from shoptrail.operators.ranking import top_per_group


def _count() -> Column:
    return F.count(F.lit(1)).alias("clickCount")


def user_daily_counts(clicks: DataFrame) -> DataFrame:
    """Clicks per day, user and ad."""
    counts = clicks.groupBy(F.to_date("ts").alias("day"), "userid", "adid").agg(_count())
    return counts.select(day_key("day").alias("date"), "userid", "adid", "clickCount")


def users_to_ban(counts: DataFrame, above: int = BAN_ABOVE_CLICKS) -> DataFrame:
    """Users with more than ``above`` clicks on one ad on one day."""
    return counts.where(F.col("clickCount") > above).select("userid").distinct()


def drop_banned(clicks: DataFrame, blacklist: DataFrame) -> DataFrame:
    return clicks.join(blacklist, "userid", "left_anti")


def city_totals(clicks: DataFrame) -> DataFrame:
    """Clicks per day, province, city and ad."""
    counts = clicks.groupBy(F.to_date("ts").alias("day"), "province", "city", "adid").agg(_count())
    return counts.select(day_key("day").alias("date"), "province", "city", "adid", "clickCount")


def province_totals(totals: DataFrame) -> DataFrame:
    return totals.groupBy("date", "province", "adid").agg(F.sum("clickCount").alias("clickCount"))


def province_top_ads(totals: DataFrame, k: int = TOP_ADS) -> DataFrame:
    """The ``k`` most clicked ads of each day and province, from city totals."""
    order = [F.desc("clickCount"), F.asc("adid")]
    top = top_per_group(province_totals(totals), ["date", "province"], order, k)
    return top.select("date", "province", "adid", "clickCount")


def _minute_columns(minute: Column) -> list[Column]:
    key = minute_key(minute)
    return [
        F.substring(key, 1, 8).alias("date"),
        F.substring(key, 9, 2).alias("hour"),
        F.substring(key, 11, 2).alias("minute"),
    ]


def _per_minute(clicks: DataFrame) -> DataFrame:
    return clicks.groupBy(F.date_trunc("minute", "ts").alias("at"), "adid").agg(_count())


def minute_trend(clicks: DataFrame) -> DataFrame:
    """Clicks per minute and ad."""
    return _per_minute(clicks).select(*_minute_columns(F.col("at")), "adid", "clickCount")


def last_hour(clicks: DataFrame, minutes: int = 60) -> DataFrame:
    """For each minute with clicks on an ad: the ad's clicks in the ``minutes`` ending with it.

    The window runs over minutes, not clicks: at most 1,440 rows per ad and day.
    """
    trailing = (
        Window.partitionBy("adid").orderBy(F.unix_timestamp("at")).rangeBetween(-60 * (minutes - 1), 0)
    )
    return (
        _per_minute(clicks)
        .withColumn("clickCount", F.sum("clickCount").over(trailing))
        .select(*_minute_columns(F.col("at")), "adid", "clickCount")
    )

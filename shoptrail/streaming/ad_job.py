"""The advertising stream as one job: blacklist, counts, totals, top ads and trend.

Every micro-batch drops the clicks of users banned before it, then updates keyed tables. A
micro-batch is an ordinary DataFrame, so the steps are the batch functions of ``operators.ads``.
Running values live in the tables, not in the query. A query with a new checkpoint goes on where the
tables stand (``storage.claim``), and a batch that runs again gives the same rows, since it
reads the tables as they were before it. Lines that the lost checkpoint had read already are counted
again if the source still offers them: that is the source's position, which only a checkpoint keeps.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from shoptrail import schemas
from shoptrail.fixed_values import BAN_ABOVE_CLICKS, RESULT_TABLES, TRIGGER_SECONDS
from shoptrail.operators import ads
from shoptrail.sinks.keyed import KeyedTable
from shoptrail.sources.ad_log import parse_ad_lines
from shoptrail.storage import claim
from shoptrail.streaming.running import rank_touched


@dataclass(frozen=True)
class AdTables:
    """The five result tables of the job."""

    user_counts: KeyedTable
    blacklist: KeyedTable
    city_totals: KeyedTable
    province_top: KeyedTable
    trend: KeyedTable
    folder: str

    @classmethod
    def below(cls, spark: SparkSession, folder: str) -> "AdTables":
        def table(name, schema, rule, keys, value=None, partition=None):
            path = f"{folder}/{RESULT_TABLES[name]}"
            return KeyedTable(spark, path, schema, rule, keys, value, partition)

        return cls(
            table(
                "ad_user_counts",
                schemas.AD_USER_COUNTS,
                "add",
                ("date", "userid", "adid"),
                "clickCount",
                "date",
            ),
            table("ad_blacklist", schemas.AD_BLACKLIST, "insert", ("userid",)),
            table(
                "ad_city_totals",
                schemas.AD_CITY_TOTALS,
                "add",
                ("date", "province", "city", "adid"),
                "clickCount",
                "date",
            ),
            table("ad_province_top3", schemas.AD_PROVINCE_TOP3, "replace_group", ("date", "province"), partition="date"),
            table(
                "ad_trend",
                schemas.AD_TREND,
                "add",
                ("date", "hour", "minute", "adid"),
                "clickCount",
                "date",
            ),
            folder,
        )


def process_batch(clicks: DataFrame, batch: int | str, tables: AdTables, ban_above: int = BAN_ABOVE_CLICKS) -> None:
    """Apply one micro-batch of parsed clicks to the tables."""
    banned = tables.blacklist.current(before=batch)
    allowed = ads.drop_banned(clicks, banned).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        cities = ads.city_totals(allowed).persist(StorageLevel.MEMORY_AND_DISK)
        tables.city_totals.apply(cities, batch)
        rank_touched(cities, tables.city_totals, tables.province_top, batch)
        cities.unpersist()
        tables.trend.apply(ads.minute_trend(allowed), batch)
        users = ads.user_daily_counts(allowed).persist(StorageLevel.MEMORY_AND_DISK)
        tables.user_counts.apply(users, batch)
        totals = tables.user_counts.sharing(users, ["date", "userid", "adid"])
        # Last, as Spark drops cached rows that were made from a table once the table is written.
        tables.blacklist.apply(ads.users_to_ban(totals, ban_above), batch)
        users.unpersist()
    finally:
        allowed.unpersist()


def start_ad_job(
    lines: DataFrame,
    tables: AdTables,
    checkpoint: str,
    ban_above: int = BAN_ABOVE_CLICKS,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start the job on a stream of ad log lines."""
    name = claim(tables.blacklist.spark, tables.folder, checkpoint)
    return (
        parse_ad_lines(lines, observe_as="ad_lines")
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": f"{TRIGGER_SECONDS} seconds"}))
        .foreachBatch(lambda batch, batch_id: process_batch(batch, f"{name}-{batch_id}", tables, ban_above))
        .start()
    )

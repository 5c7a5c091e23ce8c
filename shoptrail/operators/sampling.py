"""Stratified session sample: quotas per day and hour, picked repeatably."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoptrail.fixed_values import SAMPLE_ALLOWANCE
from shoptrail.functions.times import date_hour, format_time
from shoptrail.operators.ranking import broadcast_up_to, top_per_group
from shoptrail.operators.sessions import session_lists


def _with_hour(sessions: DataFrame) -> DataFrame:
    part = F.split(date_hour(F.col("start_time")), "_")
    return sessions.withColumns({"date": F.get(part, F.lit(0)), "hour": F.get(part, F.lit(1))})


def hourly_counts(sessions: DataFrame) -> DataFrame:
    """Sessions per day and hour of their start."""
    start = F.date_trunc("hour", "start_time")
    counts = sessions.groupBy(start.alias("start_time")).agg(F.count(F.lit(1)).alias("session_count"))
    return _with_hour(counts).select("date", "hour", "session_count")


def sample_quota(hours: DataFrame, allowance: int = SAMPLE_ALLOWANCE) -> DataFrame:
    """How many sessions of each day and hour to pick.

    Each day gets ``allowance / number of days`` (whole), each hour its share of the day, truncated.
    The input has 24 rows a day at most, so counting the days in one window is cheap.
    """
    of_day = Window.partitionBy("date")
    first_of_day = F.when(F.row_number().over(of_day.orderBy("hour")) == 1, 1)
    counted = hours.withColumns(
        {"day_count": F.sum("session_count").over(of_day), "first_of_day": first_of_day}
    ).withColumn("days", F.count("first_of_day").over(Window.partitionBy()))
    per_day = F.floor(F.lit(allowance) / F.col("days"))
    share = F.floor(F.col("session_count") / F.col("day_count") * per_day)
    return counted.select(
        "date", "hour", "session_count", F.least(share, F.col("session_count")).alias("quota")
    )


def pick_sessions(sessions: DataFrame, allowance: int = SAMPLE_ALLOWANCE, seed: str = "0") -> DataFrame:
    """Ids and start times of the sampled sessions: ``allowance`` rows at most.

    Within an hour sessions are ordered by a hash of their id and the seed, so the pick is random
    but repeatable. No hour needs more than ``allowance`` candidates, so even an hour that holds
    most sessions is trimmed before the shuffle.
    """
    quota = sample_quota(hourly_counts(sessions), allowance).select("date", "hour", "quota")
    lottery = F.md5(F.concat_ws("|", F.col("session_id"), F.lit(seed)))
    candidates = _with_hour(sessions.select("session_id", "start_time")).withColumn("lottery", lottery)
    drawn = top_per_group(
        candidates, ["date", "hour"], [F.col("lottery"), F.col("session_id")], allowance, "draw"
    )
    # 24 quota rows a day.
    return (
        drawn.join(F.broadcast(quota), ["date", "hour"])
        .where(F.col("draw") <= F.col("quota"))
        .select("session_id", "start_time")
    )


def session_sample(
    actions: DataFrame,
    sessions: DataFrame,
    task_id: str,
    allowance: int = SAMPLE_ALLOWANCE,
    seed: str = "0",
) -> DataFrame:
    """The sample with keywords and categories, which are collected for the picked sessions only.

    Values are made distinct before they are collected, so repeated values of a large session do
    not travel to one task.
    """
    # The quotas sum to ``allowance`` rows at most.
    picked = broadcast_up_to(pick_sessions(sessions, allowance, seed), allowance)
    values = (
        actions.join(picked, "session_id")
        .select("session_id", "start_time", "search_keyword", "click_category_id")
        .distinct()
    )
    lists = values.groupBy("session_id", "start_time").agg(
        *(column.alias(name) for name, column in session_lists().items())
    )
    return lists.select(
        F.lit(task_id).alias("taskid"),
        F.col("session_id").alias("sessionid"),
        format_time("start_time").alias("startTime"),
        F.col("search_keywords").alias("searchKeywords"),
        F.col("click_category_ids").alias("clickCategoryIds"),
    )


def sample_detail(
    actions: DataFrame,
    sessions: DataFrame,
    task_id: str,
    allowance: int = SAMPLE_ALLOWANCE,
    seed: str = "0",
) -> DataFrame:
    """Every action of the sampled sessions."""
    picked = broadcast_up_to(pick_sessions(sessions, allowance, seed).select("session_id"), allowance)
    return actions.join(picked, "session_id", "left_semi").select(
        F.lit(task_id).alias("taskid"),
        F.col("user_id").alias("userid"),
        F.col("session_id").alias("sessionid"),
        F.col("page_id").alias("pageid"),
        format_time("action_time").alias("actionTime"),
        F.col("search_keyword").alias("searchKeyword"),
        F.col("click_category_id").alias("clickCategoryId"),
        F.col("click_product_id").alias("clickProductId"),
        F.col("order_category_ids").alias("orderCategoryIds"),
        F.col("order_product_ids").alias("orderProductIds"),
        F.col("pay_category_ids").alias("payCategoryIds"),
        F.col("pay_product_ids").alias("payProductIds"),
    )

"""Category popularity and the most active sessions of popular categories.

Everything here starts from counts per session and category. They are made before the join with
the kept sessions, and both analyses can share them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptrail.fixed_values import NOTHING, TOP_CATEGORIES, TOP_SESSIONS
from shoptrail.operators.ranking import top_per_group


_KINDS = ("click", "order", "pay")


def session_category_counts(actions: DataFrame) -> DataFrame:
    """Clicks, orders and payments of each session on each category that it touched.

    One pass: each action gives its lists of ids with their kind, and one aggregation counts all
    kinds. Plain generators keep this in generated code, unlike functions over arrays. A session
    of any size leaves a task as one row per category.
    """
    click = F.when(F.col("click_category_id") != NOTHING, F.col("click_category_id").cast("string"))
    lists = zip(_KINDS, (click, F.col("order_category_ids"), F.col("pay_category_ids")))
    tagged = [part for kind, ids in lists for part in (F.lit(kind), ids)]
    return (
        actions.select("session_id", F.stack(F.lit(len(_KINDS)), *tagged).alias("kind", "ids"))
        .where("ids IS NOT NULL")
        .select("session_id", "kind", F.explode(F.split("ids", ",")).alias("id"))
        # An item that is no number (a comma too many) is dropped.
        .select("session_id", "kind", F.col("id").try_cast("bigint").alias("categoryid"))
        .where("categoryid IS NOT NULL")
        .groupBy("session_id", "categoryid")
        .agg(*(F.count_if(F.col("kind") == kind).alias(f"{kind}Count") for kind in _KINDS))
    )


def category_counts(per_session: DataFrame) -> DataFrame:
    """Clicks, orders and payments of every category that has any of them."""
    return per_session.groupBy("categoryid").agg(
        *(F.sum(f"{kind}Count").alias(f"{kind}Count") for kind in _KINDS)
    )


def _one_count(per_session: DataFrame, count: str) -> DataFrame:
    return per_session.where(F.col(count) > 0).groupBy("categoryid").agg(F.sum(count).alias(count))


def category_clicks(per_session: DataFrame) -> DataFrame:
    return _one_count(per_session, "clickCount")


def category_orders(per_session: DataFrame) -> DataFrame:
    return _one_count(per_session, "orderCount")


def category_pays(per_session: DataFrame) -> DataFrame:
    return _one_count(per_session, "payCount")


def top_categories(counts: DataFrame, task_id: str, k: int = TOP_CATEGORIES) -> DataFrame:
    """The ``k`` categories with most clicks, then orders, then payments; equal ones by id."""
    return (
        counts.orderBy(
            F.desc("clickCount"), F.desc("orderCount"), F.desc("payCount"), F.asc("categoryid")
        )
        .limit(k)
        .select(F.lit(task_id).alias("taskid"), "categoryid", "clickCount", "orderCount", "payCount")
    )


def top_category_sessions(
    per_session: DataFrame, top: DataFrame, task_id: str, k: int = TOP_SESSIONS
) -> DataFrame:
    """For each category in ``top`` the ``k`` sessions with most clicks on it."""
    clicks = per_session.where("clickCount > 0").join(top.select("categoryid"), "categoryid", "left_semi")
    ranked = top_per_group(clicks, ["categoryid"], [F.desc("clickCount"), F.asc("session_id")], k)
    return ranked.select(
        F.lit(task_id).alias("taskid"), "categoryid", F.col("session_id").alias("sessionid"), "clickCount"
    )

"""Session roll-up, user attributes and session filters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptrail.fixed_values import NOTHING
from shoptrail.functions.text import distinct_list, is_not_empty
from shoptrail.functions.times import seconds_between
from shoptrail.operators.sequence import first_action_key
from shoptrail.params import TaskParams


def _keyword() -> Column:
    return F.when(is_not_empty(F.col("search_keyword")), F.col("search_keyword"))


def _category() -> Column:
    return F.when(F.col("click_category_id") != NOTHING, F.col("click_category_id"))


def _any_of(column: Column, wanted) -> Column:
    return F.coalesce(F.bool_or(column.isin(*wanted)), F.lit(False))


def session_lists() -> dict[str, Column]:
    """Aggregates: distinct searched keywords, and distinct clicked categories in numeric order."""
    return {
        "search_keywords": distinct_list(_keyword()),
        "click_category_ids": F.array_join(
            F.transform(F.array_sort(F.collect_set(_category())), lambda c: c.cast("string")), ","
        ),
    }


def session_rollup(actions: DataFrame, params: TaskParams | None = None) -> DataFrame:
    """One row per session: user, start and end, visit and step length, keywords, categories.

    Every aggregate is combined inside the tasks before the shuffle, so a session of any size
    arrives as one row per task. Whether a session searched or clicked something that ``params``
    asks for is a flag of its own: filters need no list, and Catalyst then drops the two lists.
    """
    aggregates = {
        "user_id": F.min_by("user_id", first_action_key(actions)),
        "start_time": F.min("action_time"),
        "end_time": F.max("action_time"),
        "step_length": F.count(F.lit(1)),
        **session_lists(),
    }
    if params is not None and params.keywords:
        aggregates["keyword_hit"] = _any_of(_keyword(), params.keywords)
    if params is not None and params.category_ids:
        aggregates["category_hit"] = _any_of(_category(), params.category_ids)
    sessions = actions.groupBy("session_id").agg(*(c.alias(name) for name, c in aggregates.items()))
    return sessions.withColumn("visit_length", seconds_between(F.col("start_time"), F.col("end_time")))


def with_users(sessions: DataFrame, users: DataFrame) -> DataFrame:
    """Add the user's attributes; sessions of unknown users are dropped."""
    return sessions.join(users.select("user_id", "age", "professional", "city", "sex"), "user_id")


def session_predicates(params: TaskParams) -> dict[str, Column]:
    """One predicate per filter that is set."""
    found = {}
    low, high = params.start_age, params.end_age
    if low is not None and high is not None:
        found["age"] = F.col("age").between(low, high)
    elif params.strict_bounds and low is not None:
        found["age"] = F.col("age") >= low
    elif params.strict_bounds and high is not None:
        found["age"] = F.col("age") <= high
    if params.professionals:
        found["professional"] = F.col("professional").isin(*params.professionals)
    if params.cities:
        found["city"] = F.col("city").isin(*params.cities)
    if params.sex:
        found["sex"] = F.col("sex") == params.sex
    if params.keywords:
        found["keyword"] = F.col("keyword_hit")
    if params.category_ids:
        found["category"] = F.col("category_hit")
    return found


def kept_sessions(actions: DataFrame, users: DataFrame, params: TaskParams) -> DataFrame:
    """Sessions with user attributes that pass every filter of ``params``."""
    sessions = with_users(session_rollup(actions, params), users)
    return reduce(DataFrame.where, session_predicates(params).values(), sessions).drop(
        "keyword_hit", "category_hit"
    )


def of_sessions(rows: DataFrame, sessions: DataFrame) -> DataFrame:
    """Rows (actions, or counts per session) of the given sessions.

    Counts per session are better joined than actions: a session has few rows then, whatever its
    size. With raw actions a very large session is left to adaptive execution's skew join.
    """
    return rows.join(sessions.select("session_id"), "session_id", "left_semi")

"""Time between consecutive actions of a session."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptrail.functions import times
from shoptrail.functions.text import two_digits
from shoptrail.operators.sequence import HOT_ROWS, action_order, add_neighbour


def action_gaps(actions: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """For every action the time of the action before, the seconds since, and its day and minute."""
    order = action_order(actions)
    needed = actions.select(*dict.fromkeys(["session_id", *order, "page_id"]))
    rows = add_neighbour(
        needed, "session_id", order, {"action_time": "previous"}, -1, hot_rows=hot_rows
    )
    now, previous = F.col("action_time"), F.col("previous")
    return rows.select(
        "session_id",
        *(c for c in ("event_id",) if c in rows.columns),
        "page_id",
        times.format_time(now).alias("action_time"),
        times.format_time(previous).alias("previous_time"),
        times.seconds_between(previous, now).alias("gap_seconds"),
        times.before(previous, now).alias("previous_is_before"),
        times.after(previous, now).alias("previous_is_after"),
        times.day_key(now).alias("day_key"),
        times.format_date(times.parse_day_key(times.day_key(now))).alias("day"),
        times.minute_key(now).alias("minute_key"),
        two_digits(F.hour(now).cast("string")).alias("hour"),
    )

"""Time helpers as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_time(text) -> Column:
    """``2019-09-10 5:03:07`` or ``2019-09-10 05:03:07`` -> timestamp without zone; null if neither.

    The cast takes hours of one or two digits and, unlike a pattern, stays in generated code.
    """
    return F.col(text).try_cast("timestamp_ntz") if isinstance(text, str) else text.try_cast("timestamp_ntz")


def format_time(time) -> Column:
    return F.date_format(time, "yyyy-MM-dd HH:mm:ss")


def format_date(time) -> Column:
    return F.date_format(time, "yyyy-MM-dd")


def date_hour(time) -> Column:
    return F.date_format(time, "yyyy-MM-dd_HH")


def day_key(time) -> Column:
    return F.date_format(time, "yyyyMMdd")


def parse_day_key(key) -> Column:
    return F.to_date(key, "yyyyMMdd")


def minute_key(time) -> Column:
    return F.date_format(time, "yyyyMMddHHmm")


def seconds_between(start, end) -> Column:
    """Whole seconds from ``start`` to ``end``, truncated."""
    return F.timestamp_diff("SECOND", start, end)


def before(first: Column, second: Column) -> Column:
    return first < second


def after(first: Column, second: Column) -> Column:
    return first > second


def today() -> Column:
    return F.date_format(F.current_date(), "yyyy-MM-dd")


def yesterday() -> Column:
    return F.date_format(F.date_sub(F.current_date(), 1), "yyyy-MM-dd")


def time_of_millis(millis) -> Column:
    return F.timestamp_millis(millis)

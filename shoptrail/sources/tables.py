"""Scans of the input tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptrail import schemas
from shoptrail.fixed_values import CITY_AREAS, NOTHING
from shoptrail.functions.times import parse_time, today, yesterday
from shoptrail.params import TaskParams


def first_and_last_day(params: TaskParams) -> tuple[Column, Column]:
    """The range's ends as texts; without dates yesterday and today in the session's time zone, which are constants of a query's plan."""
    first = yesterday() if params.start_date is None else F.lit(params.start_date)
    return first, today() if params.end_date is None else F.lit(params.end_date)


def in_dates(table: DataFrame, params: TaskParams) -> DataFrame:
    """Rows of the closed date range. On a table partitioned by ``date`` this prunes partitions.

    ``date`` may be a date or text ``yyyy-MM-dd``; the bounds take its type.
    """
    return table.where(F.col("date").between(*first_and_last_day(params)))


def visit_actions(table: DataFrame, params: TaskParams) -> DataFrame:
    """Visit actions of the date range, with ``action_time`` as a timestamp."""
    return in_dates(table, params).withColumn("action_time", parse_time("action_time"))


def product_clicks(table: DataFrame, params: TaskParams) -> DataFrame:
    """City and product of each product click of the date range; only two columns are read on."""
    return (
        in_dates(table, params)
        .where(F.col("click_product_id") != NOTHING)
        .select("city_id", "click_product_id")
    )


def city_areas(spark: SparkSession) -> DataFrame:
    """The built-in city dimension."""
    return spark.createDataFrame(list(CITY_AREAS), schemas.CITY_AREA)


def user_info(spark: SparkSession, table: str = "user_info") -> DataFrame:
    return spark.read.table(table)


def product_info(spark: SparkSession, table: str = "product_info") -> DataFrame:
    return spark.read.table(table)

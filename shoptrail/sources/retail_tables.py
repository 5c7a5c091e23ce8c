"""The input tables built from the star schema ``events customer part nation region``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptrail.fixed_values import NOTHING
from shoptrail.functions.text import two_digits
from shoptrail.params import TaskParams
from shoptrail.sources.tables import first_and_last_day

AD_EVENTS = ("click", "view")


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def user_visit_action(events: DataFrame, params: TaskParams | None = None) -> DataFrame:
    """Events as visit actions. The date range also filters ``ts``, so that it reaches the scan."""
    if params is not None:
        first, last = (day.cast("date") for day in first_and_last_day(params))
        last = F.date_add(last, 1)
        events = events.where(
            (F.col("ts") >= first.cast("timestamp_ntz")) & (F.col("ts") < last.cast("timestamp_ntz"))
        )
    kind = F.col("event_type")
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("bigint")
    date = F.to_date("ts")
    day = date.cast("string")
    # Sessions sit in one hour of the day, and hours are written without a leading zero.
    second = F.floor((F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")) / 24).cast("int")
    hour = (F.col("user_id") % 23).cast("string")
    return events.select(
        date.alias("date"),
        "user_id",
        F.concat(F.col("user_id").cast("string"), F.lit("_"), F.replace(day, F.lit("-"), F.lit(""))).alias(
            "session_id"
        ),
        (F.col("event_id") % 10).alias("page_id"),
        F.concat(
            day,
            F.lit(" "),
            hour,
            F.lit(":"),
            two_digits(F.floor(second / 60).cast("string")),
            F.lit(":"),
            two_digits((second % 60).cast("string")),
        ).alias("action_time"),
        F.when(kind == "view", F.concat(F.lit("kw"), (k % 10).cast("string"))).alias("search_keyword"),
        F.when(kind == "click", k).otherwise(NOTHING).alias("click_category_id"),
        F.when(kind == "click", F.col("event_id") % 100).otherwise(NOTHING).alias("click_product_id"),
        F.when(
            kind == "purchase", F.concat(k.cast("string"), F.lit(","), ((k + 1) % 100).cast("string"))
        ).alias("order_category_ids"),
        F.when(kind == "purchase", (F.col("event_id") % 100).cast("string")).alias("order_product_ids"),
        F.when(kind == "signup", k.cast("string")).alias("pay_category_ids"),
        F.when(kind == "signup", (F.col("event_id") % 100).cast("string")).alias("pay_product_ids"),
        (F.col("user_id") % 25).alias("city_id"),
        "event_id",
    )


def user_info(customer: DataFrame) -> DataFrame:
    return customer.select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("username"),
        F.col("c_name").alias("name"),
        (F.col("c_custkey") % 60).cast("int").alias("age"),
        F.col("c_mktsegment").alias("professional"),
        F.concat(F.lit("city"), F.col("c_nationkey").cast("string")).alias("city"),
        F.when(F.col("c_custkey") % 2 == 0, "male").otherwise("female").alias("sex"),
    )


def product_info(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.concat(F.lit('{"product_status": '), (F.col("p_partkey") % 2).cast("string"), F.lit("}")).alias(
            "extend_info"
        ),
    )


def city_area(nation: DataFrame, region: DataFrame) -> DataFrame:
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").cast("bigint").alias("city_id"),
        F.col("n_name").alias("city_name"),
        F.col("r_name").alias("area"),
    )


def ad_lines(events: DataFrame, cities: DataFrame) -> DataFrame:
    """Clicks and views as ad log lines; works on a stream of events too."""
    clicks = events.where(F.col("event_type").isin(*AD_EVENTS)).withColumn("city_id", F.col("user_id") % 25)
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("bigint")
    return clicks.join(cities, "city_id").select(
        F.concat_ws(
            " ",
            F.unix_millis(F.col("ts").cast("timestamp")).cast("string"),
            F.replace(F.col("area"), F.lit(" "), F.lit("_")),
            F.col("city_name"),
            F.col("user_id").cast("string"),
            (k % 20).cast("string"),
        ).alias("value")
    )

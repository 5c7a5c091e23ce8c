"""Most clicked products of each area."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptrail import fixed_values as fixed
from shoptrail.functions.text import distinct_list, join_id_name, json_field
from shoptrail.operators.ranking import top_per_group


def area_product_clicks(clicks: DataFrame, cities: DataFrame) -> DataFrame:
    """Clicks and cities of each area and product; clicks of unknown cities are dropped.

    Clicks are first counted per city and product, so the join with the city dimension and the
    grouping by area see one row per city and product, however many clicks a city has.
    """
    per_city = clicks.groupBy("city_id", F.col("click_product_id").alias("pid")).agg(
        F.count(F.lit(1)).alias("clicks")
    )
    return (
        per_city.join(cities, "city_id")
        .groupBy("area", "pid")
        .agg(
            F.sum("clicks").alias("click_count"),
            distinct_list(join_id_name(F.col("city_id"), F.col("city_name"))).alias("city_infos"),
        )
    )


def product_status(extend_info: Column, own: str = fixed.OWN_PRODUCT, other: str = fixed.OTHER_PRODUCT) -> Column:
    return F.when(json_field(extend_info, "product_status") == "0", own).otherwise(other)


def with_products(area_clicks: DataFrame, products: DataFrame, **labels: str) -> DataFrame:
    """Add name and status of the product; unknown products are dropped."""
    return area_clicks.join(products, F.col("pid") == F.col("product_id")).select(
        "area",
        "pid",
        "click_count",
        "city_infos",
        "product_name",
        product_status(F.col("extend_info"), **labels).alias("product_status"),
    )


def area_level(area: Column, levels: dict[str, str], other: str) -> Column:
    level = F.create_map(*(F.lit(v) for v in chain.from_iterable(levels.items())))
    return F.coalesce(F.try_element_at(level, area), F.lit(other))


def area_top_products(
    area_products: DataFrame,
    task_id: str,
    k: int = fixed.TOP_PRODUCTS,
    levels: dict[str, str] | None = None,
    other_level: str = fixed.OTHER_AREA_LEVEL,
) -> DataFrame:
    """The ``k`` most clicked products of each area; equal ones by product id."""
    top = top_per_group(area_products, ["area"], [F.desc("click_count"), F.asc("pid")], k)
    return top.select(
        F.lit(task_id).alias("taskid"),
        "area",
        area_level(F.col("area"), levels or fixed.AREA_LEVELS, other_level).alias("areaLevel"),
        F.col("pid").alias("productid"),
        F.col("city_infos").alias("cityInfos"),
        F.col("click_count").alias("clickCount"),
        F.col("product_name").alias("productName"),
        F.col("product_status").alias("productStatus"),
    )

"""The area job: most clicked products of each area, as DataFrames or as SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame

from shoptrail.fixed_values import OTHER_PRODUCT, OWN_PRODUCT, RESULT_TABLES
from shoptrail.functions.sql import register_functions
from shoptrail.operators import area
from shoptrail.params import TaskParams
from shoptrail.sinks.tables import register_views
from shoptrail.sources.tables import city_areas, product_clicks


def run_area_job(
    action_table: DataFrame,
    products: DataFrame,
    params: TaskParams,
    write: Callable[[DataFrame, str], None],
    cities: DataFrame | None = None,
    task_id: str | None = None,
) -> str:
    task_id = task_id or str(uuid.uuid4())
    cities = city_areas(action_table.sparkSession) if cities is None else cities
    clicks = area.area_product_clicks(product_clicks(action_table, params), cities)
    top = area.area_top_products(area.with_products(clicks, products), task_id)
    write(top, RESULT_TABLES["area_top3"])
    return task_id


PRODUCTS_BY_AREA = """
WITH per_city AS (
  SELECT city_id, click_product_id AS pid, count(*) AS n
  FROM clicks_in
  GROUP BY city_id, click_product_id
), per_area AS (
  SELECT area, pid, sum(n) AS total,
         array_sort(collect_set(concat_long_string(city_id, city_name, ':'))) AS places
  FROM per_city NATURAL JOIN cities_in
  GROUP BY area, pid
)
SELECT area, pid, total AS click_count, array_join(places, ',') AS city_infos, product_name,
       CASE get_json_field(extend_info, 'product_status') WHEN '0' THEN :own ELSE :other END AS product_status
FROM products_in
JOIN per_area ON product_id = pid
"""


def area_products_in_sql(clicks: DataFrame, cities: DataFrame, products: DataFrame) -> DataFrame:
    """Products of each area with clicks, cities and status, written in SQL over temporary views."""
    spark = clicks.sparkSession
    register_functions(spark)
    register_views(
        clicks_in=clicks.select("city_id", "click_product_id"), cities_in=cities.select("city_id", "city_name", "area"), products_in=products
    )
    return spark.sql(PRODUCTS_BY_AREA, args={"own": OWN_PRODUCT, "other": OTHER_PRODUCT})

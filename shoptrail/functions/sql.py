"""The helper functions under their SQL names, for people who write SQL.

Both are SQL expressions that Catalyst inlines, so they cost no more than built-ins.
``group_concat_distinct(x)`` needs no function of its own: Spark has
``listagg(DISTINCT x, ',') WITHIN GROUP (ORDER BY x)``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def register_functions(spark: SparkSession) -> None:
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION concat_long_string(id BIGINT, name STRING, separator STRING) "
        "RETURNS STRING RETURN concat(CAST(id AS STRING), separator, name)"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION get_json_field(json STRING, field STRING) "
        "RETURNS STRING RETURN get_json_object(json, concat('$.', field))"
    )

"""A Spark session for local runs and benchmarks; on a cluster use the one you are given."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def build_session(name: str, cpus: int | str = 8, memory: str = "8g", **conf: str) -> SparkSession:
    settings = {
        "spark.driver.memory": memory,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(cpus),
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="shoptrail-warehouse-"),
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="shoptrail-shared-"),
    } | conf
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark

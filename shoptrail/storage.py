"""The shared folder of a run: staged intermediate tables and folder look-ups.

Data that several steps read is written once as Parquet to the folder the cluster names in
``spark.checkpoint.dir``. A written table survives the loss of executors, cuts the lineage, and
is read back column by column, which a cached or checkpointed plan is not.
"""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


@cache
def _local_folder(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="shoptrail-")


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only a local session without it gets a folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return _local_folder(spark.conf.get("spark.app.id"))


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


class Staging:
    """Tables that one run writes to the shared folder and deletes when it ends."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.folder = spark, new_folder(spark, label)

    def __enter__(self) -> "Staging":
        return self

    def __exit__(self, *error) -> None:
        delete_folder(self.spark, self.folder)

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` once and return the written table."""
        path = f"{self.folder}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(f.getPath().toString() for f in found or ())


def finished_folders(spark: SparkSession, pattern: str) -> list[str]:
    """Folders matching ``pattern`` whose Spark write has been committed."""
    return [path.rsplit("/", 1)[0] for path in matching_paths(spark, f"{pattern}/_SUCCESS")]


def folder_bytes(spark: SparkSession, folder: str) -> int:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()


def make_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)


def claim(spark: SparkSession, folder: str, checkpoint: str) -> str:
    """The name under which the query with this checkpoint writes to the tables below ``folder``.

    A checkpoint that has offsets keeps the name it was given; a new one, or one deleted and begun
    again, gets the next. An older checkpoint cannot go on once a newer one has written.
    """
    mine = hashlib.sha256(checkpoint.encode()).hexdigest()
    claims = sorted((int(path.rsplit("/claim=", 1)[1].split("/")[0]), path.rsplit("/", 1)[1]) for path in matching_paths(spark, f"{folder}/_claims/claim=*/*"))
    if matching_paths(spark, f"{checkpoint}/offsets/*"):
        held = [number for number, owner in claims if owner == mine]
        if held and held[-1] == claims[-1][0]:
            return f"q{held[-1]}"
        if held:
            raise ValueError(f"a newer checkpoint has written to {folder}")
    number = claims[-1][0] + 1 if claims else 0
    make_folder(spark, f"{folder}/_claims/claim={number}/{mine}")
    return f"q{number}"


def delete_at_end(spark: SparkSession, folder: str) -> None:
    """Delete the folder when the application's file system is closed."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

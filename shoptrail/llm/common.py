"""Reading, per-text Python steps in Arrow batches, and staged tables, shared by the operators."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from functools import cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from shoptrail.storage import new_folder

#: Rows handled at a time inside a task; bounds what Python holds besides the Arrow batch.
SLICE = 256


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@cache
def _ship(application_id: str, context) -> None:
    package = Path(__file__).resolve().parent.parent
    archive = os.path.join(tempfile.mkdtemp(prefix="shoptrail-code-"), "shoptrail_code.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(archive)


def ship_code(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, in case they lack it."""
    _ship(spark.sparkContext.applicationId, spark.sparkContext)


def per_text(
    df: DataFrame,
    keep: list[str],
    text: str,
    make: Callable[[], Callable[[list[str]], dict[str, list]]],
    fields: str,
) -> DataFrame:
    """Columns ``keep`` of ``df`` and what ``make()`` computes for column ``text`` (null: empty).

    ``make`` runs once per task and returns a function from a list of texts to lists of values, one
    per field of ``fields`` (a DDL string). Rows are mapped one to one; nothing is shuffled. Names that
    begin with two underscores are the operators' own. A kept column named as one of ``fields`` gives way to it.
    """
    keep = [c for c in keep if c not in StructType.fromDDL(fields).fieldNames()]
    ship_code(df.sparkSession)
    value = F.col(f"`{text}`").cast("string")
    kept = df.select(*[F.col(f"`{c}`") for c in keep], *([] if text in keep else [value.alias("__text")]))
    place = kept.columns.index(text if text in keep else "__text")
    added = StructType.fromDDL(fields)
    schema = StructType([*kept.drop("__text").schema.fields, *added.fields])
    names = added.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                made = step([t or "" for t in part.column(place).to_pylist()])
                columns = [part.column(i) for i in range(len(keep))] + [pa.array(made[n], type=kinds[n]) for n in names]
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names[: len(keep)], *names])

    kinds = {f.name: f.type for f in to_arrow_schema(added)}
    return kept.mapInArrow(run, schema)


def stage(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """``df`` written once as Parquet to the run's shared folder, and read again.

    This cuts the lineage: a lost executor costs its own tasks, not the steps before. The folder is
    deleted when the application's file system is closed.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    delete_at_end(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def delete_at_end(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)

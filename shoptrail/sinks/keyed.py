"""Keyed result tables for ``foreachBatch``: upserts by Spark's dynamic partition overwrite.

A table is cut into parts: its days, or some hash buckets of its keys where it has no days. A batch is
combined with the parts it touches, and these are written anew; other parts stay as they are. How rows combine is the
table's rule:

``add``            values of the same key are summed
``replace``        the value of the batch holds
``replace_group``  a group (say day and province) has the rows of the batch
``insert``         a key is inserted once

A part's rows stand in a folder that names their version and the batch that wrote them. The newest version is the part; the one before is
kept, for readers that have opened it and for the batch itself: when a batch runs again, it starts from the newest version that
is not its own, and overwrites what it wrote. So a replay cannot count twice, and a crash at any moment loses nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoptrail.storage import delete_folder, folder_bytes, matching_paths

_PART, _VERSION, _BATCH = "part", "version", "batch"
# Rows of a batch, and bytes already there, that go to one file of a part.
FILE_ROWS = 1_000_000
FILE_BYTES = 128 << 20
# Parts of a table without days.
BUCKETS = 8


def combine(old: DataFrame, new: DataFrame, rule: str, keys: list[str], value: str | None) -> DataFrame:
    """The rows of a part after a batch."""
    if rule == "add":
        return old.unionByName(new).groupBy(*keys).agg(F.sum(value).alias(value))
    if rule == "replace":
        both = old.withColumn("_new", F.lit(False)).unionByName(new.withColumn("_new", F.lit(True)))
        return both.groupBy(*keys).agg(F.max_by(value, "_new").alias(value))
    if rule == "replace_group":
        return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)
    if rule == "insert":
        return old.unionByName(new).distinct()
    raise ValueError(f"unknown rule {rule!r}")


@dataclass(frozen=True)
class _Version:
    part: str
    number: int
    batch: str
    folder: str


@dataclass(frozen=True)
class KeyedTable:
    spark: SparkSession
    path: str
    schema: T.StructType
    rule: str
    keys: tuple[str, ...]
    value: str | None = None
    partition: str | None = None

    def _part(self) -> Column:
        if self.partition:
            return F.col(self.partition).cast("string")
        return F.pmod(F.xxhash64(*self.keys), F.lit(BUCKETS)).cast("string")

    def _versions(self, parts: list[str] | None = None) -> list[_Version]:
        """Versions of some parts or of all, oldest first."""
        which = "*" if parts is None else "{" + ",".join(parts) + "}"
        found = []
        for path in matching_paths(self.spark, f"{self.path}/{_PART}={which}/{_VERSION}=*/{_BATCH}=*"):
            part, number, batch = (piece.split("=", 1)[1] for piece in path.rsplit("/", 3)[1:])
            found.append(_Version(part, int(number), batch, path))
        return sorted(found, key=lambda v: v.number)

    def _read(self, versions: list[_Version]) -> DataFrame:
        if not versions:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*(v.folder for v in versions))

    def current(self, before: int | str | None = None, partitions: list[str] | None = None) -> DataFrame:
        """The table's rows, or its rows before batch ``before`` was applied; ``partitions`` restricts the read to some days."""
        newest = {v.part: v for v in self._versions(partitions) if before is None or v.batch != str(before)}
        return self._read(list(newest.values()))

    def sharing(self, rows: DataFrame, keys: list[str]) -> DataFrame:
        """The table's rows that share ``keys`` with ``rows``; of a table with days only those of ``rows`` are read."""
        parts = [r[0] for r in rows.select(self._part()).distinct().collect()] if self.partition in keys else None
        return self.current(partitions=parts).join(rows.select(*keys).distinct(), keys, "left_semi")

    def apply(self, rows: DataFrame, batch: int | str) -> None:
        """Combine the rows of a batch with the table; the same batch again replaces what it wrote before.

        ``batch`` names the batch among all that write to the table: its number, with the query's name if several queries write.
        """
        kept = rows.select(*self.schema.names)  # counted, then written
        held = kept.storageLevel.useMemory  # the caller's, who lets go of it
        if not held:
            kept.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            counts = {r[0]: r[1] for r in kept.groupBy(self._part()).count().collect()}
            if counts:
                self._rewrite(kept, counts, str(batch))
        finally:
            if not held:
                kept.unpersist()

    def _rewrite(self, rows: DataFrame, counts: dict[str, int], batch: str) -> None:
        before = [v for v in self._versions(list(counts)) if v.batch != batch]
        newest = list({v.part: v for v in before}.values())
        number = 1 + max((v.number for v in newest), default=-1)
        after = combine(self._read(newest), rows, self.rule, list(self.keys), self.value)
        # A batch of a stateful query runs without adaptive execution, so the rows are dealt here.
        held = sum(folder_bytes(self.spark, v.folder) for v in newest)
        salts = 1 + max(sum(counts.values()) // FILE_ROWS, held // FILE_BYTES)
        dealt = after.withColumns({_PART: self._part(), _VERSION: F.lit(number), _BATCH: F.lit(batch)})
        dealt = dealt.repartition(F.col(_PART), F.pmod(F.xxhash64(*self.schema.names), F.lit(salts)))
        stored = dealt.select(*self.schema.names, _PART, _VERSION, _BATCH)
        writer = stored.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(_PART, _VERSION, _BATCH).parquet(self.path)
        for version in before:
            if version not in newest:
                delete_folder(self.spark, version.folder.rsplit("/", 1)[0])

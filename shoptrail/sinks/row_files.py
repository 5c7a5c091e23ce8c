"""A streaming sink written as a Python data source: each task writes its rows, each batch is committed once.

    spark.dataSource.register(RowFilesSource)
    rows.writeStream.format("row_files").option("path", folder).option("checkpointLocation", ...).start()
    spark.read.format("row_files").option("path", folder).schema(rows.schema).load()

A task writes its rows to a file of its own and reports the file's name. When all tasks of a batch are done, one
manifest, named after the batch, lists their files. Files that no manifest names (of tasks that were lost, ran twice, or whose
batch failed) are never read. A batch that is committed again keeps its first manifest.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import Row, StructType

#: Rows held by a task at a time.
ROWS_AT_ONCE = 10_000


def _file_system(path: str):
    from pyarrow import fs

    found, inside = fs.FileSystem.from_uri(path)
    return found, inside.rstrip("/")


@dataclass
class TaskFile(WriterCommitMessage):
    """What a task reports: its file, or no name if it had no rows."""

    name: str | None
    rows: int


class RowFilesSource(DataSource):
    """Parquet files listed by a manifest per batch. Option ``path``: a folder or URI that all executors reach."""

    @classmethod
    def name(cls) -> str:
        return "row_files"

    def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamWriter:
        return RowFilesWriter(self.options["path"], schema)

    def reader(self, schema: StructType) -> DataSourceReader:
        return RowFilesReader(self.options["path"], schema)


class RowFilesWriter(DataSourceStreamWriter):
    def __init__(self, path: str, schema: StructType):
        self.path, self.schema = path, schema

    def write(self, iterator: Iterator[Row]) -> TaskFile:
        """Runs in a task: one file for all its rows."""
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import to_arrow_schema

        files, folder = _file_system(self.path)
        files.create_dir(f"{folder}/rows", recursive=True)
        name, schema = f"{uuid.uuid4().hex}.parquet", to_arrow_schema(self.schema)
        writer, held, rows = None, [], 0
        try:
            for row in iterator:
                held.append(row.asDict(recursive=True))
                rows += 1
                if len(held) == ROWS_AT_ONCE:
                    writer = writer or pq.ParquetWriter(f"{folder}/rows/{name}", schema, filesystem=files)
                    writer.write_table(pa.Table.from_pylist(held, schema))
                    held = []
            if held:
                writer = writer or pq.ParquetWriter(f"{folder}/rows/{name}", schema, filesystem=files)
                writer.write_table(pa.Table.from_pylist(held, schema))
        finally:
            if writer:
                writer.close()
        return TaskFile(name if rows else None, rows)

    def commit(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:
        """Runs on the driver, and may run again for a batch that was committed just before a crash."""
        files, folder = _file_system(self.path)
        files.create_dir(f"{folder}/batches", recursive=True)
        target = f"{folder}/batches/{batchId:012d}.json"
        if _exists(files, target):
            self.abort(messages, batchId)
            return
        listed = [{"name": m.name, "rows": m.rows} for m in messages if m is not None and m.name]
        draft = f"{folder}/batches/_{uuid.uuid4().hex}"  # a manifest appears whole or not at all
        with files.open_output_stream(draft) as out:
            out.write(json.dumps(listed).encode())
        files.move(draft, target)

    def abort(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:
        """Delete what the tasks have written; files of tasks that never reported stay unread."""
        files, folder = _file_system(self.path)
        for message in messages:
            if message is not None and message.name and _exists(files, f"{folder}/rows/{message.name}"):
                files.delete_file(f"{folder}/rows/{message.name}")


@dataclass
class _File(InputPartition):
    name: str


class RowFilesReader(DataSourceReader):
    def __init__(self, path: str, schema: StructType):
        self.path, self.schema = path, schema

    def partitions(self) -> list[_File]:
        files, folder = _file_system(self.path)
        names = []
        for path in manifests(self.path):
            with files.open_input_stream(path) as lines:
                names += [entry["name"] for entry in json.loads(lines.read())]
        return [_File(n) for n in names]

    def read(self, partition: _File | None) -> Iterator:
        import pyarrow.parquet as pq

        if partition is None:  # a table of no files has one partition of nothing
            return
        files, folder = _file_system(self.path)
        with files.open_input_file(f"{folder}/rows/{partition.name}") as data:
            for batch in pq.ParquetFile(data).iter_batches(columns=self.schema.names):
                yield batch


def manifests(path: str) -> list[str]:
    """The committed batches' manifests, in order of the batches."""
    from pyarrow import fs

    files, folder = _file_system(path)
    found = files.get_file_info(fs.FileSelector(f"{folder}/batches", allow_not_found=True))
    return sorted(f.path for f in found if f.base_name.endswith(".json"))


def _exists(files, path: str) -> bool:
    from pyarrow import fs

    return files.get_file_info(path).type != fs.FileType.NotFound

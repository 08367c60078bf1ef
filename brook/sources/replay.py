"""A custom stream source: a stored parquet table replayed by offset.

One offset is one file of the table, in name order. A micro-batch reads all files
past its start offset, each as one parallel partition, row group by row group. A
partition is named by its file, so a restarted query or a retried task reads the
same rows again. Files added later must sort after those already there.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from brook.sources.files import filesystem


@dataclass
class StoredFile(InputPartition):
    path: str


def stored_files(path: str) -> list[str]:
    """The table's files by name; a listing only, nothing is opened."""
    from pyarrow import fs

    store, root = filesystem(path)
    if store.get_file_info(root).type == fs.FileType.File:
        return [path]
    found = store.get_file_info(fs.FileSelector(root, recursive=True))
    scheme = path.split("://")[0] + "://" if "://" in path else ""
    return sorted(
        scheme + f.path for f in found if f.type == fs.FileType.File and f.path.endswith(".parquet"))


class ReplayReader(DataSourceStreamReader):
    def __init__(self, schema: StructType, options: dict):
        self.columns = schema.fieldNames()
        self.path = options["path"]

    def initialOffset(self) -> dict:
        return {"file": 0}

    def latestOffset(self) -> dict:
        return {"file": len(stored_files(self.path))}

    def partitions(self, start: dict, end: dict) -> list[StoredFile]:
        return [StoredFile(p) for p in stored_files(self.path)[start["file"]:end["file"]]]

    def read(self, partition: StoredFile) -> Iterator:
        import pyarrow.parquet as pq

        store, path = filesystem(partition.path)
        with store.open_input_file(path) as source:
            yield from pq.ParquetFile(source).iter_batches(columns=self.columns)

    def commit(self, end: dict) -> None:
        pass


class ReplaySource(DataSource):
    """``spark.readStream.format("brook_replay").schema(...).option("path", folder)``."""

    @classmethod
    def name(cls) -> str:
        return "brook_replay"

    def schema(self) -> StructType:
        raise ValueError("brook_replay needs a schema")

    def streamReader(self, schema: StructType) -> ReplayReader:
        return ReplayReader(schema, self.options)

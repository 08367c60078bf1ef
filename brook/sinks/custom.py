"""A custom sink with open, write and close per task and a commit per batch.

Each task writes its three columns as JSON lines to a file named after batch and
task attempt. Only files listed in the batch's commit record count, so files of
lost or repeated tasks are never read back.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage,
)
from pyspark.sql.types import Row, StructType

from brook.sources.files import filesystem

ROWS = "user_id int, item_id string, behavior string"


@dataclass
class Written(WriterCommitMessage):
    file: str
    rows: int


class RowsWriter:
    """Shared by the batch and the streaming writer."""

    def __init__(self, options: dict):
        self.folder = options["path"]

    def write(self, rows: Iterator[Row]) -> Written:
        store, folder = filesystem(self.folder)
        store.create_dir(f"{folder}/data", recursive=True)
        name, n = f"{uuid.uuid4().hex}.jsonl", 0
        with store.open_output_stream(f"{folder}/data/{name}") as out:
            for row in rows:
                out.write((json.dumps(row.asDict()) + "\n").encode())
                n += 1
        return Written(name, n)

    def record(self, messages, batch: str) -> None:
        """One small file per batch; a repeated commit replaces it by the same list."""
        store, folder = filesystem(self.folder)
        store.create_dir(f"{folder}/commits", recursive=True)
        listed = [{"file": m.file, "rows": m.rows} for m in messages if m is not None and m.rows]
        with store.open_output_stream(f"{folder}/commits/{batch}.jsonl") as out:
            out.write("".join(json.dumps(x) + "\n" for x in listed).encode())


class BatchRowsWriter(RowsWriter, DataSourceWriter):
    def commit(self, messages) -> None:
        self.record(messages, uuid.uuid4().hex)

    def abort(self, messages) -> None:
        pass  # without a commit record nothing counts


class StreamRowsWriter(RowsWriter, DataSourceStreamWriter):
    def commit(self, messages, batchId: int) -> None:
        self.record(messages, f"batch-{batchId}")

    def abort(self, messages, batchId: int) -> None:
        pass


class RowsSink(DataSource):
    """``df.write.format("brook_rows")`` and ``df.writeStream.format("brook_rows")``.

    ``path`` is a folder that all executors share.
    """

    @classmethod
    def name(cls) -> str:
        return "brook_rows"

    def writer(self, schema: StructType, overwrite: bool) -> BatchRowsWriter:
        return BatchRowsWriter(self.options)

    def streamWriter(self, schema: StructType, overwrite: bool) -> StreamRowsWriter:
        return StreamRowsWriter(self.options)


def read_committed(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of all committed files."""
    listed = spark.read.schema("file string, rows bigint").json(f"{folder}/commits/*.jsonl")
    rows = spark.read.schema(ROWS).json(f"{folder}/data").withColumn(
        "file", F.element_at(F.split(F.input_file_name(), "/"), -1))
    return rows.join(listed.select("file").distinct(), "file", "left_semi").drop("file")

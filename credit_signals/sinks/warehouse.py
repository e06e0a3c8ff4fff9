"""A warehouse connector as a Python data source: ``df.write.format("credit_warehouse")``.

Each write task streams its Arrow batches into one Parquet file of its own and
returns a commit message (file, rows).  When all tasks have succeeded, the one
commit on the driver names exactly these files in the table's next manifest; a
failed job is aborted, its files go, and the table stays as it was.  A task that
runs twice (a retry, speculation, a lost executor) leaves a second file that no
message names.  The number of rows written is the sum of the messages, so no
table is read again to count it.

Reading goes through Spark's own Parquet reader over the manifest's files
(``read_table``), or through the data source itself, one partition per file.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext, cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema

from credit_signals.sinks import manifest as M

FORMAT = "credit_warehouse"
ROW_GROUP_ROWS = 1 << 20


@dataclass
class FileWritten(WriterCommitMessage):
    file: str
    rows: int


@dataclass
class FilePart(InputPartition):
    file: str


class WarehouseWriter(DataSourceArrowWriter):
    def __init__(self, path: str, schema: T.StructType, overwrite: bool):
        self.path, self.schema, self.overwrite, self.run = path, schema, overwrite, M.new_run()

    def write(self, iterator: Iterator[pa.RecordBatch]) -> FileWritten:
        """One file per task that has rows; its name is new for every attempt."""
        task = TaskContext.get()
        name = f"files/{self.run}/part-{task.partitionId() if task else 0:06d}-{uuid.uuid4().hex}.parquet"
        files, root = M.open_path(self.path)
        schema = to_arrow_schema(self.schema)
        rows, out = 0, None
        try:
            for batch in iterator:
                if batch.num_rows:
                    if out is None:
                        files.create_dir(f"{root}/files/{self.run}", recursive=True)
                        out = pq.ParquetWriter(f"{root}/{name}", schema, filesystem=files)
                    out.write_table(pa.Table.from_batches([batch]).cast(schema), row_group_size=ROW_GROUP_ROWS)
                    rows += batch.num_rows
        finally:
            if out is not None:
                out.close()
        return FileWritten(name, rows)

    def commit(self, messages: list[FileWritten | None]) -> None:
        done = [m for m in messages if m is not None and m.rows]
        M.commit(self.path, self.schema.json(), [{"file": m.file, "rows": m.rows} for m in done], append=not self.overwrite)
        M.remove_run(self.path, self.run, keep={m.file for m in done})

    def abort(self, messages: list[FileWritten | None]) -> None:
        M.remove_run(self.path, self.run)


class WarehouseReader(DataSourceReader):
    def __init__(self, path: str, number: int | None):
        self.path, self.number = path, number

    def partitions(self) -> list[FilePart]:
        return [FilePart(f["file"]) for f in M.read(self.path, self.number).files] or [FilePart("")]

    def read(self, partition: FilePart) -> Iterator[pa.RecordBatch]:
        if partition.file:
            files, root = M.open_path(self.path)
            yield from pq.ParquetFile(files.open_input_file(f"{root}/{partition.file}")).iter_batches()


class WarehouseTable(DataSource):
    """Options: ``path`` (the table) and, for reading, ``version`` (a manifest's number; the latest by default)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def _number(self) -> int | None:
        return int(self.options["version"]) if "version" in self.options else None

    def schema(self) -> T.StructType:
        import json
        return T.StructType.fromJson(json.loads(M.read(self.options["path"], self._number()).schema))

    def reader(self, schema: T.StructType) -> WarehouseReader:
        return WarehouseReader(self.options["path"], self._number())

    def writer(self, schema: T.StructType, overwrite: bool) -> WarehouseWriter:
        return WarehouseWriter(self.options["path"], schema, overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known to a session; its code travels with the jobs."""
    for module in (sys.modules[__name__], M):
        cloudpickle.register_pickle_by_value(module)
    try:
        spark.dataSource.register(WarehouseTable)
    except AnalysisException as error:            # sessions of one application may share the registry
        if error.getCondition() != "DATA_SOURCE_ALREADY_EXISTS":
            raise


def write_table(df: DataFrame, path: str, mode: str = "overwrite", options: dict | None = None) -> int:
    """Write ``df`` as the table's next version; the rows of this write, as its tasks reported them."""
    register(df.sparkSession)
    before = M.read(path).rows if mode == "append" and M.numbers(path) else 0
    df.write.format(FORMAT).options(**(options or {})).mode(mode).save(path)
    return M.read(path).rows - before


def read_table(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The latest version, or the one with this number, by Spark's Parquet reader."""
    import json
    version = M.read(path, number)
    schema = T.StructType.fromJson(json.loads(version.schema))
    if not version.files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path.rstrip('/')}/{f['file']}" for f in version.files])

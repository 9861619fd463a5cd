"""A table of files that takes each batch once, all of it or nothing.

Tasks write their rows to files in a staging folder, under a name of the attempt. When all are done the
driver names those files in one note, ``epochs/<stream>/<number>``, which is written under another name
and moved: with that move the batch is in the table. A batch that failed leaves its staged files, which
are removed, and no note. A batch whose note is there already changes nothing, so a stream that
repeats its last batch after a crash, or a job that is started twice under one number, counts once.
Readers read the files that notes name (``committed``).

    spark.dataSource.register(StagedTable)
    df.write.format("staged_table").mode("append").option("stream", "load").option("epoch", 7).save(path)
    stream.writeStream.format("staged_table").option("stream", "facts").start(path)
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from contextlib import suppress
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType


#: Seconds in which a batch that failed removes what its other tasks, which are being stopped, still write; Spark
#: gives their Python workers 2.
LATE = 3.0


def file_system(path: str) -> tuple[arrow_fs.FileSystem, str]:
    return arrow_fs.FileSystem.from_uri(path if ":/" in path else f"file://{path}")


@dataclass
class Staged(WriterCommitMessage):
    """A file that a task has written to its end; without a name where it had no rows."""

    name: str
    rows: int


class _Table:
    """Files, staged files and notes of one table."""

    def __init__(self, path: str, stream: str):
        self.path, self.stream = path.rstrip("/"), stream
        self.attempt = uuid.uuid4().hex

    def stage(self, batches: Iterator[pa.RecordBatch]) -> Staged:
        """Rows of one task into a file of its own."""
        system, root = file_system(self.path)
        name = f"{self.attempt}-{uuid.uuid4().hex}.parquet"
        writer, rows = None, 0
        try:
            for batch in batches:
                if writer is None:
                    system.create_dir(f"{root}/files", recursive=True)
                    writer = pq.ParquetWriter(f"{root}/files/{name}", batch.schema, filesystem=system)
                writer.write_batch(batch)
                rows += batch.num_rows
        except BaseException:
            if writer is not None:
                writer.close()
                self.remove({name})
            raise
        if writer is None:
            return Staged("", 0)
        writer.close()
        return Staged(name, rows)

    def _note(self, epoch: int) -> str:
        return f"epochs/{self.stream}/{epoch:012d}"

    def commit(self, staged: list[Staged | None], epoch: int) -> None:
        system, root = file_system(self.path)
        note = f"{root}/{self._note(epoch)}"
        if system.get_file_info(note).type != arrow_fs.FileType.NotFound:
            self.remove({s.name for s in staged if s and s.name})
            return
        system.create_dir(note.rpartition("/")[0], recursive=True)
        kept = sorted(s.name for s in staged if s and s.name)
        with system.open_output_stream(f"{note}.{self.attempt}") as out:
            out.write(json.dumps({"files": kept, "rows": sum(s.rows for s in staged if s)}).encode())
        system.move(f"{note}.{self.attempt}", note)
        # What attempts of tasks that were given up have left.
        self.remove(self._of_attempt() - set(kept))

    def abort(self) -> None:
        until = time.monotonic() + LATE
        while time.monotonic() < until:
            self.remove(self._of_attempt())
            time.sleep(0.1)
        self.remove(self._of_attempt())

    def _of_attempt(self) -> set[str]:
        system, root = file_system(self.path)
        files = system.get_file_info(arrow_fs.FileSelector(f"{root}/files", allow_not_found=True))
        return {f.base_name for f in files if f.base_name.startswith(self.attempt)}

    def remove(self, names: set[str]) -> None:
        system, root = file_system(self.path)
        for name in names:
            with suppress(FileNotFoundError):  # its task, or the driver, was first
                system.delete_file(f"{root}/files/{name}")


class StagedWriter(DataSourceArrowWriter):
    """One batch under a number that the caller gives."""

    def __init__(self, table: _Table, epoch: int):
        self.table, self.epoch = table, epoch

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        return self.table.stage(iterator)

    def commit(self, messages: list[Staged | None]) -> None:
        self.table.commit(messages, self.epoch)

    def abort(self, messages: list[Staged | None]) -> None:
        self.table.abort()


class StagedStreamWriter(DataSourceStreamArrowWriter):
    """Batches under the numbers of their stream."""

    def __init__(self, table: _Table):
        self.table = table

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        return self.table.stage(iterator)

    def commit(self, messages: list[Staged | None], batchId: int) -> None:
        self.table.commit(messages, batchId)

    def abort(self, messages: list[Staged | None], batchId: int) -> None:
        self.table.abort()


class StagedTable(DataSource):
    """Options: ``path``; ``stream``, a name under which batches are numbered; ``epoch``, the number of a
    batch that is no stream's."""

    @classmethod
    def name(cls) -> str:
        return "staged_table"

    def _table(self) -> _Table:
        return _Table(self.options["path"], self.options.get("stream", "batch"))

    def writer(self, schema: StructType, overwrite: bool) -> StagedWriter:
        if overwrite or "epoch" not in self.options:
            raise ValueError("append, with an epoch")
        return StagedWriter(self._table(), int(self.options["epoch"]))

    def streamWriter(self, schema: StructType, overwrite: bool) -> StagedStreamWriter:
        return StagedStreamWriter(self._table())


def committed(spark: SparkSession, path: str, schema: StructType, epochs: DataFrame | None = None) -> DataFrame:
    """The table's rows: of all batches, or of those listed as (stream, epoch).

    The driver gets the names of files, which it lists for any scan.
    """
    system, root = file_system(path)
    notes = system.get_file_info(arrow_fs.FileSelector(f"{root}/epochs", recursive=True, allow_not_found=True))
    found = {
        tuple(n.path.rsplit("/", 2)[1:]): n.path for n in notes if n.type == arrow_fs.FileType.File and n.base_name.isdigit()
    }
    if epochs is not None:
        wanted = {(r[0], f"{r[1]:012d}") for r in epochs.collect()}
        found = {k: p for k, p in found.items() if k in wanted}
    files = []
    for note in found.values():
        with system.open_input_file(note) as file:
            files += json.loads(file.read())["files"]
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path.rstrip('/')}/files/{name}" for name in sorted(files)])

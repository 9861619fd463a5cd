"""A polled audit table as a stream.

Rows are read on from a cursor ``(changed_at, audit_id)``, which is the stream's offset: the query's
checkpoint is the progress mark, so a restart neither loses nor repeats a row, and there is no mark
file. Each poll looks up the newest cursor first and reads up to there; what arrives meanwhile waits.
The range is read by several tasks, each with row groups of its own, of which those outside the
range are passed over by their statistics.

The table is a folder of Parquet files that grows. A row whose cursor is at or before one already
polled is never read, as with any poll on a time, nor is a row without a time.

    spark.dataSource.register(PolledAudit)
    spark.readStream.format("polled_audit").load("/shared/audit")
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyarrow import fs as arrow_fs
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from tallystream.schemas import AUDIT

_EPOCH = dt.datetime(1970, 1, 1)
_LEAST = -(2**63)
_TIME = pa.timestamp("us", tz="UTC")
#: Rows that a task reads, about.
SPLIT_ROWS = 200_000


@dataclass
class Slice(InputPartition):
    """Row groups of files, and the cursors after and up to which their rows are wanted."""

    start: tuple[int, int]
    end: tuple[int, int]
    groups: list[tuple[str, int]] = field(default_factory=list)


def _micros(value) -> int:
    if value.tzinfo is not None:
        value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return (value - _EPOCH) // dt.timedelta(microseconds=1)


def _file_system(path: str) -> tuple[arrow_fs.FileSystem, str]:
    return arrow_fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def _row_groups(path: str) -> Iterator[tuple[str, int, int, int | None, int | None]]:
    """File, number, rows, and least and greatest time as far as statistics tell."""
    system, folder = _file_system(path)
    if system.get_file_info(folder).type == arrow_fs.FileType.NotFound:
        return
    for piece in ds.dataset(folder, filesystem=system, format="parquet").get_fragments():
        place = piece.metadata.schema.names.index("changed_at")
        for number in range(piece.num_row_groups):
            group = piece.metadata.row_group(number)
            times = group.column(place)
            # Times in the old twelve-byte form have none.
            known = times.physical_type == "INT64" and times.statistics is not None and times.statistics.has_min_max
            low, high = (_micros(times.statistics.min), _micros(times.statistics.max)) if known else (None, None)
            if group.num_rows:
                yield piece.path, number, group.num_rows, low, high


def _rows(path: str, groups: list[tuple[str, int]], columns: list[str]) -> Iterator[pa.RecordBatch]:
    system, _ = _file_system(path)
    form = ds.ParquetFileFormat()
    for file, number in groups:
        fragment = form.make_fragment(file, filesystem=system, row_groups=[number])
        for batch in fragment.to_batches(columns=columns):
            at = columns.index("changed_at")
            times = batch.column(at).cast(pa.timestamp("us", batch.column(at).type.tz), safe=False)
            times = times.cast(pa.int64())
            yield batch.set_column(at, "changed_at", times)


class PolledReader(DataSourceStreamReader):
    def __init__(self, path: str, split_rows: int):
        self.path, self.split_rows = path, split_rows

    def initialOffset(self) -> dict:
        return {"at": _LEAST, "id": _LEAST}

    def latestOffset(self) -> dict:
        best = (_LEAST, _LEAST)
        groups = sorted(_row_groups(self.path), key=lambda g: -(2**63 if g[4] is None else g[4]))
        for file, number, _, _, high in groups:
            if high is not None and high < best[0]:
                break
            for batch in _rows(self.path, [(file, number)], ["changed_at", "audit_id"]):
                table = pa.Table.from_batches([batch]).drop_null()
                if not table.num_rows:
                    continue
                newest = pc.max(table["changed_at"])
                ids = table.filter(pc.equal(table["changed_at"], newest))["audit_id"]
                best = max(best, (newest.as_py(), pc.max(ids).as_py()))
        return {"at": best[0], "id": best[1]}

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        first, last = (start["at"], start["id"]), (end["at"], end["id"])
        slices, held = [], self.split_rows
        if first >= last:
            return []
        for file, number, rows, low, high in _row_groups(self.path):
            if (high is not None and high < first[0]) or (low is not None and low > last[0]):
                continue
            if held + rows > self.split_rows:
                slices.append(Slice(first, last))
                held = 0
            slices[-1].groups.append((file, number))
            held += rows
        return slices

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        (a, i), (b, j) = partition.start, partition.end
        for batch in _rows(self.path, partition.groups, AUDIT.names):
            at, number = batch.column(AUDIT.names.index("changed_at")), batch.column(0)
            after = pc.or_(pc.greater(at, a), pc.and_(pc.equal(at, a), pc.greater(number, i)))
            until = pc.or_(pc.less(at, b), pc.and_(pc.equal(at, b), pc.less_equal(number, j)))
            kept = batch.filter(pc.fill_null(pc.and_(after, until), False))
            if kept.num_rows:
                place = AUDIT.names.index("changed_at")
                yield kept.set_column(place, "changed_at", kept.column(place).cast(_TIME))


class PolledAudit(DataSource):
    """Options: ``path``, and ``split_rows``, about how many rows a task reads."""

    @classmethod
    def name(cls) -> str:
        return "polled_audit"

    def schema(self) -> StructType:
        return AUDIT

    def streamReader(self, schema: StructType) -> PolledReader:
        return PolledReader(self.options["path"], int(self.options.get("split_rows", SPLIT_ROWS)))

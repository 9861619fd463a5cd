"""Publish and apply as checkpointed queries.

The checkpoint is the progress mark. Each record is published at least once, and applied once: the
table refuses a record whose audit id it has applied.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tallystream.functions.derive import derive_profit
from tallystream.functions.messages import accepted, decode, encode, rejects, triage
from tallystream.schemas import TRAILING_PERIOD, YEAR
from tallystream.sources.change_log import ChangeLog

EVERY_10_SECONDS = {"processingTime": "10 seconds"}
AVAILABLE_NOW = {"availableNow": True}


def publish_stream(
    audit: DataFrame,
    checkpoint: str,
    sink_format: str,
    trigger: dict | None = None,
    company: bool = True,
    partitions: int | None = None,
    **options: str,
) -> StreamingQuery:
    """Audit stream to (key, value) records; ``partitions`` is the size of the topic, see ``encode``."""
    return (
        encode(audit, company, partitions)
        .writeStream.format(sink_format)
        .options(**options)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or EVERY_10_SECONDS))
        .start()
    )


def prepare(triaged: DataFrame, company: bool, skip_periods: list[str]) -> DataFrame:
    """Changes ready for the fold."""
    changes = accepted(triaged)
    if skip_periods:
        changes = changes.where(~F.col(YEAR).isin(skip_periods))
    return derive_profit(changes) if company else changes


def apply_records(
    table: ChangeLog,
    records: DataFrame,
    batch_id: int,
    writer: str,
    company: bool = True,
    skip_periods: list[str] | None = None,
    rejects_path: str | None = None,
) -> None:
    """One batch of records into the table's log; bad ones into their own folder per batch."""
    if skip_periods is None:
        skip_periods = [TRAILING_PERIOD] if company else []
    triaged = triage(decode(records, company), company)
    if not rejects_path:  # read once
        table.append(prepare(triaged, company, skip_periods), batch_id, writer)
        return
    triaged.persist()
    try:
        rejects(triaged).write.mode("overwrite").parquet(f"{rejects_path}/batch_id={batch_id}")
        table.append(prepare(triaged, company, skip_periods), batch_id, writer)
    finally:
        triaged.unpersist()


def apply_stream(
    records: DataFrame,
    table: ChangeLog,
    checkpoint: str,
    trigger: dict | None = None,
    company: bool = True,
    skip_periods: list[str] | None = None,
    rejects_path: str | None = None,
) -> StreamingQuery:
    """Record stream into the log of a keyed table; folding it is a job of its own."""

    def each(batch: DataFrame, batch_id: int) -> None:
        apply_records(table, batch, batch_id, checkpoint, company, skip_periods, rejects_path)

    return (
        records.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or EVERY_10_SECONDS))
        .start()
    )

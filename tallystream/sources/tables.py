"""Files, database tables and topics as DataFrames.

Format and options come from the caller; no host, login or topic is kept here.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallystream.functions.clean import parse_mark
from tallystream.operators.audit import high_water_mark, incremental_scan
from tallystream.functions.messages import encode
from tallystream.schemas import COMPANY_DIM, PAGE

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"


def read_table(spark: SparkSession, source_format: str = "parquet", path: str | None = None, **options: str) -> DataFrame:
    """Any table; for ``jdbc`` give ``partitionColumn`` and bounds so that the read is split."""
    reader = spark.read.format(source_format).options(**options)
    return reader.load(path) if path else reader.load()


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PAGE).parquet(path)


def read_companies(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(COMPANY_DIM).options(header=True, quote='"', escape='"', multiLine=True).csv(path)


def write_companies(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.select(*COMPANY_DIM.names).write.mode(mode).options(header=True, quote='"', escape='"').csv(path)


def replace_table(df: DataFrame, path: str, sink_format: str = "parquet", **options: str) -> None:
    df.write.format(sink_format).mode("overwrite").options(**options).save(path)


def append_table(df: DataFrame, path: str, sink_format: str = "parquet", **options: str) -> None:
    df.write.format(sink_format).mode("append").options(**options).save(path)


def kafka_options(servers: str, topic: str, reading: bool) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers}
    if reading:
        return {**options, "subscribe": topic, "startingOffsets": "earliest"}
    return {**options, "topic": topic}


def read_high_water(spark: SparkSession, path: str) -> tuple[str | None, int | None]:
    """Stored cursor ``(ISO time, audit id)``; nulls where nothing usable is stored.

    The folder holds one line per finished run, the time and after a tab the id; a file with
    just a time is read as well.
    """
    try:
        lines = spark.read.text(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None, None
    parts = F.split("value", "\t")
    marks = lines.select(
        parse_mark(F.get(parts, F.lit(0))).alias("changed_at"),
        F.get(parts, F.lit(1)).try_cast("long").alias("audit_id"),
    )
    row = high_water_mark(marks).select(F.date_format("changed_at", ISO).alias("at"), "audit_id").first()
    return row.at, row.audit_id


def store_high_water(spark: SparkSession, path: str, changed_at: str, audit_id: int) -> None:
    """Write a cursor; the two last ones are kept, so a crash while writing loses nothing.

    Cursors go to two folders in turn. The one that is overwritten is not the latest.
    """
    line = spark.createDataFrame([(f"{changed_at}\t{audit_id}",)], "value string")
    turns = {turn: read_high_water(spark, f"{path}/turn={turn}") for turn in (0, 1)}
    latest = max(turns, key=lambda t: (turns[t][0] or "", turns[t][1] or 0))
    line.coalesce(1).write.mode("overwrite").text(f"{path}/turn={1 - latest}")


def publish_increment(audit: DataFrame, mark_path: str, sink_format: str, company: bool = True, **options: str) -> bool:
    """Publish what came after the stored cursor, then move the cursor: at least once.

    The upper end is fixed first, so rows that arrive while writing wait for the next run.
    For a table without a Spark stream (JDBC); files and topics use ``streaming.jobs``.
    """
    spark = audit.sparkSession
    fresh = incremental_scan(audit, *read_high_water(spark, mark_path))
    end = high_water_mark(fresh).select(F.date_format("changed_at", ISO).alias("at"), "audit_id").first()
    if end.at is None:
        return False
    edge = F.lit(end.at).cast("timestamp")
    at = F.col("changed_at")
    batch = fresh.where(at <= edge).where((at < edge) | (F.col("audit_id") <= end.audit_id))
    encode(batch, company).write.format(sink_format).mode("append").options(**options).save()
    store_high_water(spark, mark_path, end.at, end.audit_id)
    return True

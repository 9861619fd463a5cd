"""Change records as key/value messages and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tallystream.functions.derive import underivable
from tallystream.schemas import (
    AVERAGE_KEY,
    COMPANY,
    DELETE,
    MESSAGE_MULTI,
    MESSAGE_SINGLE,
    METRICS,
    OPERATIONS,
    YEAR,
)

_JSON = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx",
    "dateFormat": "yyyy-MM-dd",
    "ignoreNullFields": "false",
}
_RAW = "_raw"


def encode(audit: DataFrame, company: bool = True, partitions: int | None = None) -> DataFrame:
    """Audit rows as (key, value) records: key is the audit id, value the JSON change.

    With ``partitions``, the size of a topic, a ``partition`` column sends all changes of a sink
    key to one place, so that they are read in the order they were written.
    """
    sink_key = [YEAR, COMPANY] if company else [YEAR]
    body = ["operation_type", "changed_at", YEAR, *METRICS] + ([COMPANY] if company else [])
    place = []
    if partitions:
        place = [F.pmod(F.xxhash64(*sink_key), F.lit(partitions)).cast("int").alias("partition")]
    return audit.select(
        F.col("audit_id").cast("string").cast("binary").alias("key"),
        F.to_json(F.struct(*body), _JSON).cast("binary").alias("value"),
        *place,
    )


def decode(records: DataFrame, company: bool = True) -> DataFrame:
    """Records as flat changes, with the audit id from the key and the raw text kept.

    The parsed struct is unfolded by a generator: later filters stay above it, where a plain
    projection would have the optimizer parse the text once more for each field they test.
    """
    schema = MESSAGE_MULTI if company else MESSAGE_SINGLE
    with_raw = T.StructType([*schema.fields, T.StructField(_RAW, T.StringType(), True)])
    text = F.col("value").cast("string")
    options = {"columnNameOfCorruptRecord": _RAW, "mode": "PERMISSIVE"}
    return records.select(
        F.col("key").cast("string").alias("raw_key"),
        F.col("key").cast("string").try_cast("long").alias("audit_id"),
        text.alias("raw"),
        F.inline_outer(F.array(F.from_json(text, with_raw, options))),
    )


def reject_reason(company: bool = True) -> Column:
    """Why a decoded change cannot be applied, or null when it can.

    A field that can't be read, a missing time or a key that is no audit id would change the order
    or the contents of the table, so such records are no changes at all. A deletion needs none of
    the metrics, so null ones are looked at for the other two only.
    """
    keys_missing = F.col(YEAR).isNull()
    if company:
        keys_missing = keys_missing | F.col(COMPANY).isNull()
    reason = (
        F.when(F.col("operation_type").isNull() & F.col(_RAW).isNotNull(), "malformed_json")
        .when(F.col(_RAW).isNotNull(), "malformed_field")
        .when(~F.coalesce(F.col("operation_type").isin(OPERATIONS), F.lit(False)), "unknown_operation")
        .when(F.col("audit_id").isNull(), "null_audit_id")
        .when(F.col("changed_at").isNull(), "null_time")
        .when(keys_missing, "null_key")
        .when(F.col(YEAR) == AVERAGE_KEY, "reserved_key")
    )
    if company:
        reason = reason.when(F.col("operation_type") != DELETE, underivable())
    return reason


def triage(decoded: DataFrame, company: bool = True) -> DataFrame:
    """Decoded changes with a ``reason`` column, null for the good ones."""
    return decoded.withColumn("reason", reject_reason(company)).drop(_RAW)


def accepted(triaged: DataFrame) -> DataFrame:
    return triaged.where(F.col("reason").isNull()).drop("reason", "raw", "raw_key")


def rejects(triaged: DataFrame, source: str = "messages") -> DataFrame:
    return triaged.where(F.col("reason").isNotNull()).select(
        F.lit(source).alias("source"), F.col("raw_key").alias("key"), "reason", "raw"
    )

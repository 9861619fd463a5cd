"""Joins against a side that holds at most one row per key."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tallystream.session import settle


@dataclass(frozen=True)
class JoinLimits:
    """Most bytes of a side that is broadcast; beyond, both sides are shuffled by key.

    There adaptive execution splits the partitions of hot keys, which it can do for every kind of
    join used here, because the side has one row per key.
    """

    broadcast_bytes: int = 64 << 20


DEFAULT_LIMITS = JoinLimits()
#: Bytes in memory that a byte of a compressed file may become.
INFLATION = 10
_STORED = re.compile(r"[\s:+-]*(Project|Relation|LogicalRDD|LocalRelation)\b")


def _width(column: Column, kind: T.DataType) -> tuple[int, list[Column]]:
    """Fixed bytes of a value and the columns whose length varies by row."""
    if isinstance(kind, T.StructType):
        parts = [_width(column[f.name], f.dataType) for f in kind.fields]
        return sum(p[0] for p in parts), [c for p in parts for c in p[1]]
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return 16, [F.octet_length(column)]
    if isinstance(kind, T.AtomicType):
        return 16, []
    return 16, [F.octet_length(F.to_json(F.struct(column)))]


def payload_bytes(df: DataFrame) -> int:
    """Size of a frame's rows, measured by one aggregate over it."""
    parts = [_width(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields]
    varying = [F.coalesce(c, F.lit(0)).cast("long") for p in parts for c in p[1]]
    total = F.lit(0).cast("long")
    for size in varying:
        total = total + size
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(total).alias("b")).first()
    return row.n * sum(p[0] for p in parts) + (row.b or 0)


def is_stored(df: DataFrame) -> bool:
    """Whether a frame is just columns of something stored, so that reading it again costs little."""
    lines = df._jdf.queryExecution().optimizedPlan().toString().strip().splitlines()
    return all(_STORED.match(line) for line in lines)


def _file_bytes(df: DataFrame) -> int | None:
    """Bytes of the files behind a plain scan, from the catalog; nothing is read."""
    plan = df._jdf.queryExecution().optimizedPlan()
    if "LogicalRDD" in plan.toString():
        return None
    return int(plan.stats().sizeInBytes())


def bounded_side(side: DataFrame, limits: JoinLimits = DEFAULT_LIMITS) -> tuple[DataFrame, bool]:
    """A side that is cheap to read, and whether it may be broadcast.

    A side that has to be computed is computed once, into the shared folder, and measured there.
    A plain scan whose files are small enough by far needs no measuring.
    """
    if not is_stored(side):
        side = settle(side)
    elif (size := _file_bytes(side)) is not None and size * INFLATION <= limits.broadcast_bytes:
        return side, True
    return side, payload_bytes(side) <= limits.broadcast_bytes


def lookup_join(
    rows: DataFrame,
    side: DataFrame,
    keys: list[str],
    how: str = "left",
    limits: JoinLimits = DEFAULT_LIMITS,
) -> DataFrame:
    """Join ``rows`` to ``side``, which has at most one row per key.

    A side within the limit is broadcast and ``rows`` are not moved. ``how`` is inner, left,
    left_semi or left_anti.
    """
    side, small = bounded_side(side, limits)
    return rows.join(F.broadcast(side) if small else side, keys, how)


def key_list(spark: SparkSession, column: str, values: list[str]) -> DataFrame:
    """A list written down in a job as a one-column frame."""
    return spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField(column, T.StringType())]))


def only_keys(
    rows: DataFrame, wanted: DataFrame, keys: list[str], limits: JoinLimits = DEFAULT_LIMITS
) -> DataFrame:
    """Rows whose key is listed."""
    return lookup_join(rows, wanted.select(*keys).distinct(), keys, "left_semi", limits)

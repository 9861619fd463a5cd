"""Capturing row changes as audit records, and reading them on from a mark."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from tallystream.operators.joins import lookup_join
from tallystream.operators.sequence import dense_ids
from tallystream.schemas import AUDIT, DELETE, INSERT, UPDATE
from tallystream.session import settle


def highest_id(audit: DataFrame) -> int:
    """Largest id given so far; 0 where there is none."""
    return audit.agg(F.max("audit_id")).first()[0] or 0


def _next_id(after: int) -> Column:
    """Unique ids above ``after``, ascending in scan order, gaps allowed, without a shuffle.

    Each scan partition has a range of 2**33 ids to itself. For ids that a rerun repeats, write the
    capture once and read it again.
    """
    return F.lit(after + 1).cast("long") + F.monotonically_increasing_id()


def audit_records(df: DataFrame, clock: Column | None, user: Column | None) -> DataFrame:
    """Rows with ids and operations in the audit layout; columns that are missing are null."""
    stamped = df.withColumns(
        {
            "changed_at": F.current_timestamp() if clock is None else clock,
            "changed_by": F.current_user() if user is None else user,
        }
    )
    return stamped.select(
        *[
            F.col(f.name).cast(f.dataType) if f.name in stamped.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in AUDIT.fields
        ]
    )


def _audit_columns(df: DataFrame, clock: Column | None, user: Column | None, after: int) -> DataFrame:
    return audit_records(df.withColumn("audit_id", _next_id(after)), clock, user)


def audit_seed(
    snapshot: DataFrame,
    clock: Column | None = None,
    user: Column | None = None,
    after: int = 0,
    order: list[str] | None = None,
) -> DataFrame:
    """Every row of a table as an INSERT record.

    With ``order`` ids are after + 1, after + 2, ... in that order, the same however the table is split;
    that sorts the table. Without, they ascend in scan order and have gaps.
    """
    inserts = snapshot.withColumn("operation_type", F.lit(INSERT))
    if order is not None:
        return audit_records(dense_ids(inserts, "audit_id", order, after), clock, user)
    return _audit_columns(inserts, clock, user, after)


def snapshot_diff(
    old: DataFrame,
    new: DataFrame,
    keys: list[str],
    clock: Column | None = None,
    user: Column | None = None,
    after: int = 0,
) -> DataFrame:
    """Audit records that lead from one version of a keyed table to the next.

    INSERT and UPDATE carry the new image, DELETE the whole old one. Equal rows give nothing.
    A key with several rows stops the job: pairing them up would invent changes. Rows are compared
    by two hashes of 64 bits, which hash aggregates carry; only changed keys fetch their images.
    """
    columns = old.columns
    # Null keys are equal here, which an equality on these pairs expresses.
    pairs = {f"_k{i}": F.coalesce(F.col(k).cast("string"), F.lit("")) for i, k in enumerate(keys)}
    pairs |= {f"_n{i}": F.col(k).isNull() for i, k in enumerate(keys)}
    # A hash passes nulls over, so where they are is hashed as well.
    contents = [*[F.col(f"`{c}`") for c in columns], *[F.col(f"`{c}`").isNull() for c in columns]]

    def side(df: DataFrame, name: str) -> DataFrame:
        grouped = df.groupBy(*[c.alias(n) for n, c in pairs.items()]).agg(
            F.count(F.lit(1)).alias("_rows"),
            F.max(F.xxhash64(*contents)).alias("_a"),
            F.max(F.xxhash64(F.lit(1), *reversed(contents))).alias("_b"),
        )
        single = F.when(F.col("_rows") == 1, F.struct("_a", "_b")).otherwise(
            F.raise_error(F.concat(F.lit("several rows for key "), *[F.col(f"_k{i}") for i in range(len(keys))]))
        )
        return grouped.select(*pairs, single.alias(name))

    both = side(old, "old").join(side(new, "new"), list(pairs), "full_outer")
    changed = settle(
        both.where(~F.col("old").eqNullSafe(F.col("new"))).select(
            *pairs,
            F.when(F.col("old").isNull(), INSERT)
            .when(F.col("new").isNull(), DELETE)
            .otherwise(UPDATE)
            .alias("operation_type"),
        )
    )

    def images(df: DataFrame, wanted: Column) -> DataFrame:
        keyed = df.withColumns(pairs)
        return lookup_join(keyed, changed.where(wanted), list(pairs), "inner").select("operation_type", *columns)

    gone = F.col("operation_type") == DELETE
    return _audit_columns(images(new, ~gone).unionByName(images(old, gone)), clock, user, after)


def incremental_scan(
    audit: DataFrame,
    mark: dt.datetime | str | None,
    after_id: int | None = None,
    ordered: bool = False,
) -> DataFrame:
    """Records later than the mark.

    With ``after_id`` the cursor is ``(changed_at, audit_id)``, so ties with the mark are not lost.
    The first condition is a plain comparison that reaches the file or database scan. No mark
    means everything, except that a null time is never newer than anything.
    """
    rows = audit
    if mark is not None:
        at = F.col("changed_at")
        edge = F.lit(mark).cast("timestamp")
        if after_id is None:
            rows = rows.where(at > edge)
        else:
            rows = rows.where(at >= edge).where((at > edge) | (F.col("audit_id") > after_id))
    return rows.orderBy("changed_at", "audit_id") if ordered else rows


def high_water_mark(audit: DataFrame) -> DataFrame:
    """One row: the latest ``(changed_at, audit_id)``; nulls when there is no record."""
    timed = audit.where(F.col("changed_at").isNotNull())
    return timed.agg(F.max(F.struct("changed_at", "audit_id")).alias("m")).select(
        F.col("m.changed_at").alias("changed_at"), F.col("m.audit_id").alias("audit_id")
    )

"""Applying ordered changes to a keyed table.

The result is the one a row-by-row replay in order would give, but nothing is replayed. Per key
only the last deletion and the last update matter:

* a row (old, or inserted) survives if it is later than the last deletion,
* a surviving row shows the last update if that is later than the row.

Both are maxima of one number per change, so they are hash aggregates, combined on the map side;
a hot key costs one row per task. Images are fetched for the winners only. Rows of the target that
no change concerns are not moved while the changed keys are few enough to be broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallystream.functions.order import rank
from tallystream.operators.joins import DEFAULT_LIMITS, JoinLimits, lookup_join
from tallystream.schemas import DELETE, INSERT, UPDATE
from tallystream.session import settle

IGNORE, BAG = "ignore", "bag"
ORDER = ("changed_at", "audit_id")


def last_marks(changes: DataFrame, keys: list[str], order: tuple[str, ...] = ORDER) -> DataFrame:
    """Per key: position of the last deletion and of the last update."""
    op, at = F.col("operation_type"), rank(changes.schema, *order)
    return (
        changes.where(op.isin(UPDATE, DELETE))
        .groupBy(*keys)
        .agg(F.max(F.when(op == DELETE, at)).alias("_deleted"), F.max(F.when(op == UPDATE, at)).alias("_updated"))
    )


def one_of(rows: DataFrame, keys: list[str], image: str) -> DataFrame:
    """One row per key of rows that tie; the order among equals is fixed by their contents."""
    by = Window.partitionBy(*keys).orderBy(F.xxhash64(image), F.to_json(image))
    return rows.withColumn("_n", F.row_number().over(by)).where("_n = 1").drop("_n")


def effects_of(
    changes: DataFrame, keys: list[str], values: list[str], order: tuple[str, ...], limits: JoinLimits
) -> DataFrame:
    """Marks of every updated or deleted key, with the last update's image."""
    marks = settle(last_marks(changes, keys, order))
    updates = changes.where(F.col("operation_type") == UPDATE).select(
        *keys, rank(changes.schema, *order).alias("_updated"), F.struct(*values).alias("_new")
    )
    winners = lookup_join(updates, marks.select(*keys, "_updated"), [*keys, "_updated"], "left_semi", limits)
    images = one_of(winners.select(*keys, "_new"), keys, "_new")
    return settle(marks.join(images, keys, "left"))


def apply_changes(
    target: DataFrame,
    changes: DataFrame,
    keys: list[str],
    on_insert: str = IGNORE,
    limits: JoinLimits = DEFAULT_LIMITS,
    order: tuple[str, ...] = ORDER,
) -> DataFrame:
    """The target after the changes.

    ``on_insert='ignore'``: the target has at most one row per key, an insert for a present key does
    nothing. ``on_insert='bag'``: every insert adds a row; updates and deletions hit all rows of
    the key. Rows with a null key match nothing, so triage changes first. The changes are read
    more than once: persist or settle them first if they are costly to compute.
    """
    values = [c for c in target.columns if c not in keys]
    image = F.struct(*values)
    effects = effects_of(changes, keys, values, order, limits)

    def shown(newer: Column) -> Column:
        return F.when(newer, F.col("_new")).otherwise(F.col("_old")).alias("_row")

    # Whatever concerns a row of the target is later than the row.
    old = lookup_join(target.select(*keys, image.alias("_old")), effects, keys, "left", limits)
    old = old.where(F.col("_deleted").isNull()).select(*keys, shown(F.col("_updated").isNotNull()))

    inserts = changes.where(F.col("operation_type") == INSERT).select(
        *keys, image.alias("_old"), rank(changes.schema, *order).alias("_at")
    )
    added = lookup_join(inserts, effects, keys, "left", limits).where(
        F.col("_deleted").isNull() | (F.col("_at") > F.col("_deleted"))
    )
    newer = F.coalesce(F.col("_updated") > F.col("_at"), F.lit(False))
    added = added.select(*keys, "_at", shown(newer))
    if on_insert == IGNORE:
        added = settle(added)
        first = added.groupBy(*keys).agg(F.min("_at").alias("_at"))
        earliest = lookup_join(added, first, [*keys, "_at"], "left_semi", limits).select(*keys, "_row")
        new = settle(one_of(earliest, keys, "_row"))
        # Only the keys of new rows are looked for in the target, so that is not moved either.
        taken = lookup_join(old.select(*keys), new.select(*keys), keys, "left_semi", limits).distinct()
        added = lookup_join(new, taken, keys, "left_anti", limits)
    rows = old.unionByName(added.select(*keys, "_row"))
    return rows.select(*keys, "_row.*").select(*target.columns)

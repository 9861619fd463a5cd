"""Keyed state that takes changes in any order, any number of times.

The state after a set of changes is what one replay of all of them in order of ``(changed_at,
audit_id)`` gives, however they were cut into batches, in whatever order those came, and wherever
states in between were written down. Per key it needs

* the place of the last deletion and of the last update, with that update's image, kept after
  the row is gone, so that a late change finds its place before or after them,
* every inserted row that is later than the last deletion, with the place of its insert. In a
  table with one row per key the first of them is shown; the others wait, because a late deletion
  may remove those before them.

All of that are maxima and unions, which don't depend on order. Ids of applied changes are kept as
ranges, so a change that comes again, in the same batch or in any later one, is refused.

Where it is known that nothing older than a time will come any more, ``settle_until`` drops what
only older changes could need.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tallystream.functions.order import rank
from tallystream.operators.fold import IGNORE, ORDER, effects_of
from tallystream.operators.joins import DEFAULT_LIMITS, JoinLimits, lookup_join
from tallystream.schemas import INSERT
from tallystream.session import settle

_PLACE = T.DecimalType(38, 0)
#: Place of rows that were there before any change.
_FIRST = -(10**38 - 1)
#: Ids that differ in the last bits only lie in one bucket.
_BUCKET_BITS = 16
APPLIED = "bucket long, low long, high long"


@dataclass(frozen=True)
class State:
    """``rows`` with ``_at``, the place of their insert, and ``_shown``; ``marks`` by key; ranges of ids."""

    rows: DataFrame
    marks: DataFrame
    applied: DataFrame


def rows_layout(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("_at", _PLACE), T.StructField("_shown", T.BooleanType())])


def marks_layout(schema: T.StructType, keys: list[str]) -> T.StructType:
    values = T.StructType([f for f in schema.fields if f.name not in keys])
    places = [T.StructField(c, _PLACE) for c in ("_deleted", "_updated")]
    return T.StructType([*[schema[k] for k in keys], *places, T.StructField("_new", values)])


def initial_state(spark: SparkSession, schema: T.StructType, keys: list[str], rows: DataFrame | None = None) -> State:
    """State of a table to which nothing was applied; its rows are older than any change."""
    if rows is None:
        held = spark.createDataFrame([], rows_layout(schema))
    else:
        held = rows.select(*schema.names, F.lit(str(_FIRST)).cast(_PLACE).alias("_at"), F.lit(True).alias("_shown"))
    return State(held, spark.createDataFrame([], marks_layout(schema, keys)), spark.createDataFrame([], APPLIED))


def shown(state: State, columns: list[str]) -> DataFrame:
    return state.rows.where("_shown").select(*columns)


def _bucket(column: Column) -> Column:
    return F.shiftright(column, _BUCKET_BITS)


def known_ids(ids: DataFrame, applied: DataFrame) -> DataFrame:
    """Of counted ids (audit_id, n) those that were applied before or come several times, with ``before``.

    Ids and ranges of one bucket are put in one order and gone through once.
    """
    both = ids.select(
        _bucket(F.col("audit_id")).alias("bucket"), F.col("audit_id").alias("low"), F.lit(None).cast("long").alias("high"), "n"
    ).unionByName(applied.withColumn("n", F.lit(None).cast("long")))
    # A range comes before an id that is its first.
    at = Window.partitionBy("bucket").orderBy("low", F.col("n").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    reached = both.withColumn("_reached", F.max("high").over(at)).where(F.col("n").isNotNull())
    before = F.coalesce(F.col("_reached") >= F.col("low"), F.lit(False))
    return reached.select(F.col("low").alias("audit_id"), "n", before.alias("before")).where("before or n > 1")


def ranges_of(applied: DataFrame, ids: DataFrame) -> DataFrame:
    """The ranges with more ids (a column ``audit_id``); neighbours within a bucket become one."""
    one = ids.where(F.col("audit_id").isNotNull()).select(
        _bucket(F.col("audit_id")).alias("bucket"), F.col("audit_id").alias("low"), F.col("audit_id").alias("high")
    )
    by = Window.partitionBy("bucket").orderBy("low", "high")
    parts = applied.unionByName(one).withColumn("_so_far", F.max("high").over(by.rowsBetween(Window.unboundedPreceding, -1)))
    begins = F.coalesce(F.col("low") > F.col("_so_far") + 1, F.lit(True))
    numbered = parts.withColumn("_n", F.sum(begins.cast("int")).over(by.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy("bucket", "_n").agg(F.min("low").alias("low"), F.max("high").alias("high")).drop("_n")


def only_new(changes: DataFrame, applied: DataFrame, limits: JoinLimits = DEFAULT_LIMITS) -> tuple[DataFrame, DataFrame]:
    """Changes whose id was not applied before, one of each id, and what is known of the other ids.

    Of several changes with one id the one earliest in order counts, of equal places one fixed by
    its contents. A change without an id can't be told from another and is taken as it is.
    """
    ids = changes.where(F.col("audit_id").isNotNull()).groupBy("audit_id").agg(F.count(F.lit(1)).alias("n"))
    known = settle(known_ids(ids, applied))
    if known.isEmpty():
        return changes, known
    others = lookup_join(changes, known.select("audit_id"), ["audit_id"], "left_anti", limits)
    again = lookup_join(changes, known.where("not before").select("audit_id"), ["audit_id"], "left_semi", limits)
    # Equal copies become one on the map side, so an id that comes very often is no hot key.
    contents = F.struct(*changes.columns)
    by = Window.partitionBy("audit_id").orderBy("changed_at", F.xxhash64(contents), F.to_json(contents))
    first = again.distinct().withColumn("_n", F.row_number().over(by)).where("_n = 1").drop("_n")
    # What follows reads the changes many times, and each would join them with the ids again.
    return settle(others.unionByName(first)), known


def _later(a: Column, b: Column) -> Column:
    return F.coalesce(a > b, a.isNotNull())


def _merged_marks(state: State, new: DataFrame, touched: DataFrame, keys: list[str], limits: JoinLimits) -> DataFrame:
    """Marks of every touched key, after the changes."""
    old = lookup_join(state.marks, touched, keys, "left_semi", limits)
    names = ["_deleted", "_updated", "_new"]
    a, b = new.select(*keys, F.struct(*names).alias("_a")), old.select(*keys, F.struct(*names).alias("_b"))
    both = a.join(b, keys, "full_outer")
    newer = _later(F.col("_a._updated"), F.col("_b._updated"))
    return both.select(
        *keys,
        F.greatest("_a._deleted", "_b._deleted").alias("_deleted"),
        F.greatest("_a._updated", "_b._updated").alias("_updated"),
        F.when(newer, F.col("_a._new")).otherwise(F.col("_b._new")).alias("_new"),
    )


@dataclass(frozen=True)
class Moved:
    """Shown rows of the keys that changes concern, as they were and as they are."""

    before: DataFrame
    after: DataFrame


def merge(
    state: State,
    changes: DataFrame,
    keys: list[str],
    on_insert: str = IGNORE,
    limits: JoinLimits = DEFAULT_LIMITS,
) -> tuple[State, Moved]:
    """The state with changes that are new to it, see ``only_new``, and what they moved.

    Rows of keys that no change concerns are passed on as they are, and not moved while the changed
    keys fit a broadcast. The changes are read more than once. Changes with a null key match nothing.
    """
    columns = [c for c in state.rows.columns if c not in ("_at", "_shown")]
    values = [c for c in columns if c not in keys]
    image = F.struct(*values)
    touched = settle(changes.select(*keys).distinct())
    marks = settle(_merged_marks(state, effects_of(changes, keys, values, ORDER, limits), touched, keys, limits))
    side = settle(touched.withColumn("_touched", F.lit(True)).join(marks, keys, "left"))

    def now(rows: DataFrame) -> DataFrame:
        """Rows that outlast the last deletion, as the last update leaves them."""
        marked = lookup_join(rows, side, keys, "left", limits)
        alive = marked.where(F.col("_deleted").isNull() | (F.col("_at") > F.col("_deleted")))
        row = F.when(F.col("_updated") > F.col("_at"), F.col("_new")).otherwise(F.col("_old"))
        return alive.select(*keys, row.alias("_row"), "_at", "_shown", "_touched")

    held = now(state.rows.select(*keys, image.alias("_old"), "_at", "_shown"))
    inserts = changes.where(F.col("operation_type") == INSERT).select(
        *keys, image.alias("_old"), rank(changes.schema, *ORDER).alias("_at"), F.lit(True).alias("_shown")
    )
    added = now(inserts).withColumn("_touched", F.lit(True))
    if on_insert == IGNORE:
        again = settle(held.where("_touched").unionByName(added))
        first = again.groupBy(*keys).agg(F.min("_at").alias("_first"))
        seen = lookup_join(again, first, keys, "left", limits)
        seen = seen.withColumn("_shown", F.coalesce(F.col("_at") == F.col("_first"), F.lit(True))).drop("_first")
        rows = held.where(F.col("_touched").isNull()).unionByName(seen)
    else:
        rows = held.unionByName(added)
    untouched = lookup_join(state.marks, touched, keys, "left_anti", limits)
    flat = rows.select(*keys, "_row.*", "_at", "_shown", "_touched")
    after = State(
        flat.select(*columns, "_at", "_shown"),
        untouched.unionByName(marks.where(F.coalesce("_deleted", "_updated").isNotNull())),
        ranges_of(state.applied, changes.select("audit_id")),
    )
    before = lookup_join(state.rows.where("_shown").select(*columns), touched, keys, "left_semi", limits)
    return after, Moved(before, flat.where("_touched and _shown").select(*columns))


def settle_until(state: State, time: Column) -> State:
    """The state without what only changes before a time could need."""
    edge = rank(T.StructType([T.StructField("_t", T.TimestampType()), T.StructField("_i", T.LongType())]), "_t", "_i")

    def before(df: DataFrame, place: Column) -> DataFrame:
        limit = df.withColumns({"_t": time, "_i": F.lit(None).cast("long")}).withColumn("_edge", edge)
        return limit.where(place).drop("_t", "_i", "_edge")

    rows = before(state.rows, F.col("_shown") | (F.col("_at") >= F.col("_edge")))
    marks = before(state.marks, F.greatest("_deleted", "_updated") >= F.col("_edge"))
    return State(rows, marks, state.applied)

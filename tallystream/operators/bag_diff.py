"""What changed between two versions of a table whose keys may hold several rows.

A version is a bag of rows. Of every distinct row the copies are counted, old ones down and new
ones up; what is left over is surplus. Within a key the surplus old rows and the surplus new rows are
each put in an order of their contents and paired by number: a pair is an update, an old row without
a partner a deletion, a new one an insert. Rows that didn't change give nothing.

The table's rows are compared by two 64-bit hashes that hash aggregates carry; images are fetched
for what changed only. Numbers within a key come from one sorted numbering of all surplus rows, so
a key that holds a third of them is no task of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallystream.operators.audit import audit_records
from tallystream.operators.joins import DEFAULT_LIMITS, JoinLimits, lookup_join
from tallystream.operators.sequence import dense_ids
from tallystream.schemas import DELETE, INSERT, UPDATE
from tallystream.session import settle

_HASH = ["_a", "_b"]


def _hashes(columns: list[str]) -> dict[str, Column]:
    # A hash passes nulls over, so where they are is hashed as well.
    contents = [*[F.col(f"`{c}`") for c in columns], *[F.col(f"`{c}`").isNull() for c in columns]]
    return {"_a": F.xxhash64(*contents), "_b": F.xxhash64(F.lit(1), *reversed(contents))}


def surplus(old: DataFrame, new: DataFrame, limits: JoinLimits = DEFAULT_LIMITS) -> DataFrame:
    """Distinct rows with another number of copies in the two versions: (_a, _b, _row, _n), n > 0 for new ones."""
    hashes, columns = _hashes(old.columns), old.columns

    def counted(df: DataFrame, sign: int) -> DataFrame:
        return df.select(*[c.alias(n) for n, c in hashes.items()], F.lit(sign).cast("long").alias("_n"))

    counts = counted(old, -1).unionByName(counted(new, 1)).groupBy(*_HASH).agg(F.sum("_n").alias("_n"))
    changed = settle(counts.where("_n <> 0"))

    def images(df: DataFrame, wanted: Column) -> DataFrame:
        rows = df.select(*[c.alias(n) for n, c in hashes.items()], F.struct(*columns).alias("_row"))
        found = lookup_join(rows, changed.where(wanted).select(*_HASH), _HASH, "left_semi", limits)
        return found.groupBy(*_HASH).agg(F.any_value("_row").alias("_row"))

    gone, come = F.col("_n") < 0, F.col("_n") > 0
    both = images(old.select(*columns), gone).unionByName(images(new.select(*columns), come))
    return settle(changed.join(both, _HASH))


def bag_diff(old: DataFrame, new: DataFrame, keys: list[str], limits: JoinLimits = DEFAULT_LIMITS) -> DataFrame:
    """Rows (operation_type, old, new): the images before and after, null where there is none.

    Both versions have the same columns. Null keys are keys, equal to each other. The records don't depend
    on the order of rows or on how the tables are split.
    """
    pairs = {f"_k{i}": F.coalesce(F.col(f"_row.{k}").cast("string"), F.lit("")) for i, k in enumerate(keys)}
    pairs |= {f"_n{i}": F.col(f"_row.{k}").isNull() for i, k in enumerate(keys)}
    names = list(pairs)
    each = surplus(old, new, limits).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.abs("_n"))))
    rows = each.select(*[c.alias(n) for n, c in pairs.items()], (F.col("_n") > 0).alias("_new"), *_HASH, "_copy")
    numbered = settle(dense_ids(rows, "_id", [*names, "_new", *_HASH, "_copy"]))
    first = numbered.groupBy(*names, "_new").agg(F.min("_id").alias("_first"))
    placed = lookup_join(numbered, first, [*names, "_new"], "inner", limits).withColumn("_at", F.col("_id") - F.col("_first"))
    images = each.where("_copy = 1").select(*_HASH, "_row")

    def side(is_new: bool, name: str) -> DataFrame:
        own = placed.where(F.col("_new") == is_new).select(*names, "_at", *_HASH)
        return own.join(images, _HASH).select(*names, "_at", F.col("_row").alias(name))

    both = side(False, "old").join(side(True, "new"), [*names, "_at"], "full_outer")
    operation = F.when(F.col("old").isNull(), INSERT).when(F.col("new").isNull(), DELETE).otherwise(UPDATE)
    return both.select(operation.alias("operation_type"), "old", "new")


def replay_bag(version: DataFrame, records: DataFrame) -> DataFrame:
    """The version after the records of ``bag_diff``: their old images leave it, their new ones enter it.

    A record whose old image isn't there stops the job: it belongs to another version.
    """
    columns = version.columns
    image = F.struct(*columns).alias("_row")
    hashes = _hashes(columns)
    moved = records.select(F.inline(F.array(F.struct(F.col("old").alias("_row"), F.lit(-1).alias("_n")), F.struct(F.col("new").alias("_row"), F.lit(1).alias("_n")))))
    moved = moved.where(F.col("_row").isNotNull()).select("_row.*", F.col("_n").cast("long").alias("_n"))
    counted = version.withColumn("_n", F.lit(1).cast("long")).unionByName(moved).select(
        *[c.alias(n) for n, c in hashes.items()], image, "_n"
    )
    left = counted.groupBy(*_HASH).agg(F.sum("_n").alias("_n"), F.any_value("_row").alias("_row"))
    copies = F.when(F.col("_n") >= 0, F.col("_n")).otherwise(F.raise_error(F.lit("an old image is not in the table")))
    some = left.withColumn("_n", copies).where("_n > 0").withColumn("_copy", F.explode(F.expr("sequence(1L, _n)")))
    return some.select("_row.*").select(*columns)


def bag_audit(
    old: DataFrame,
    new: DataFrame,
    keys: list[str],
    clock: Column | None = None,
    user: Column | None = None,
    after: int = 0,
) -> DataFrame:
    """The difference as audit records, one per row as a row trigger writes them: the new image, or the old
    one of a deletion. Ids go up from ``after`` without gaps, deletions first, then by key and contents."""
    records = bag_diff(old, new, keys)
    image = F.coalesce("new", "old")
    flat = records.select("operation_type", image.alias("_row")).select("operation_type", "_row.*")
    numbered = dense_ids(flat, "audit_id", [F.col("operation_type") != DELETE, *keys], after)
    return audit_records(numbered, clock, user)


def keyed_audit(
    old: DataFrame,
    new: DataFrame,
    keys: list[str],
    clock: Column | None = None,
    user: Column | None = None,
    after: int = 0,
) -> DataFrame:
    """The difference as audit records for a sink that updates and deletes by key.

    There an update or a deletion hits all rows of its key, so a key that had or gets several rows
    and changed is deleted and inserted anew; other keys get one record. Applied to a bag, the
    records lead from one version to the other.
    """
    records = bag_diff(old, new, keys)
    names = [f"_k{i}" for i in range(len(keys))] + [f"_n{i}" for i in range(len(keys))]

    def keyed(df: DataFrame) -> DataFrame:
        texts = {f"_k{i}": F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("")) for i, k in enumerate(keys)}
        return df.withColumns(texts | {f"_n{i}": F.col(f"`{k}`").isNull() for i, k in enumerate(keys)})

    flat = records.select("operation_type", F.coalesce("new", "old").alias("_row")).select("operation_type", "_row.*")
    changed = settle(keyed(flat).select(*names).distinct())

    def held(df: DataFrame, name: str) -> DataFrame:
        some = lookup_join(keyed(df), changed, names, "left_semi")
        return some.groupBy(*names).agg(F.count(F.lit(1)).alias(name))

    counts = changed.join(held(old, "_old"), names, "left").join(held(new, "_new"), names, "left")
    several = settle(counts.where("_old > 1 or _new > 1").select(*names))
    single = lookup_join(keyed(flat), several, names, "left_anti")
    gone = lookup_join(keyed(old), several, names, "left_semi").groupBy(*names).agg(
        F.any_value(F.struct(*old.columns)).alias("_row")
    )
    gone = gone.select(F.lit(DELETE).alias("operation_type"), "_row.*")
    come = lookup_join(keyed(new), several, names, "left_semi").select(F.lit(INSERT).alias("operation_type"), *new.columns)
    all_ = single.select("operation_type", *old.columns).unionByName(gone).unionByName(come)
    numbered = dense_ids(all_, "audit_id", [F.col("operation_type") != DELETE, *keys], after)
    return audit_records(numbered, clock, user)

"""Keyed writes as joins that produce the next version of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallystream.functions.order import rank
from tallystream.operators.fold import one_of
from tallystream.operators.joins import DEFAULT_LIMITS, JoinLimits, lookup_join
from tallystream.session import settle


def _one_per_key(rows: DataFrame, keys: list[str], pick, order: list[str], limits: JoinLimits) -> DataFrame:
    """The row of the extreme position per key: positions are aggregated, then images fetched.

    ``order`` is one or two columns of times or whole numbers. The rows are read twice.
    """
    values = [c for c in rows.columns if c not in keys]
    placed = rows.select(*keys, F.struct(*values).alias("_v"), rank(rows.schema, *order).alias("_at"))
    # Null keys are keys as well here, which a join on equality would lose.
    pairs = {f"_k{i}": F.coalesce(F.col(k).cast("string"), F.lit("")) for i, k in enumerate(keys)}
    pairs |= {f"_n{i}": F.col(k).isNull() for i, k in enumerate(keys)}
    placed, names = placed.withColumns(pairs), list(pairs)
    extreme = placed.groupBy(*names).agg(pick("_at").alias("_at"))
    chosen = one_of(lookup_join(placed, extreme, [*names, "_at"], "left_semi", limits), names, "_v")
    return chosen.select(*keys, "_v.*").select(*rows.columns)


def first_per_key(
    rows: DataFrame, keys: list[str], order: list[str], limits: JoinLimits = DEFAULT_LIMITS
) -> DataFrame:
    return _one_per_key(rows, keys, F.min, order, limits)


def last_per_key(
    rows: DataFrame, keys: list[str], order: list[str], limits: JoinLimits = DEFAULT_LIMITS
) -> DataFrame:
    return _one_per_key(rows, keys, F.max, order, limits)


def keyed_update(
    target: DataFrame, updates: DataFrame, keys: list[str], limits: JoinLimits = DEFAULT_LIMITS
) -> DataFrame:
    """Rows whose key has an update take its values; ``updates`` has one row per key."""
    values = [c for c in target.columns if c not in keys]
    # The values travel as one struct, so an update to null stays an update.
    side = updates.select(*keys, F.struct(*values).alias("_new"))
    joined = lookup_join(target, side, keys, "left", limits)
    row = F.coalesce(F.col("_new"), F.struct(*values))
    return joined.select(*keys, row.alias("_row")).select(*keys, "_row.*").select(*target.columns)


def keyed_delete(
    target: DataFrame, deletes: DataFrame, keys: list[str], limits: JoinLimits = DEFAULT_LIMITS
) -> DataFrame:
    """Rows whose key is not listed."""
    return lookup_join(target, deletes.select(*keys).distinct(), keys, "left_anti", limits)


def upsert_ignore(
    target: DataFrame,
    new: DataFrame,
    keys: list[str],
    order: list[str],
    limits: JoinLimits = DEFAULT_LIMITS,
) -> DataFrame:
    """Insert rows whose key is absent; the first of several new rows per key wins.

    The target's keys are cut down to those the new rows have before they are looked up, so a
    small batch never moves a large target.
    """
    first = settle(first_per_key(new, keys, order, limits).select(*target.columns))
    taken = lookup_join(target.select(*keys), first.select(*keys), keys, "left_semi", limits).distinct()
    return target.unionByName(lookup_join(first, taken, keys, "left_anti", limits))


def upsert_replace(
    target: DataFrame,
    new: DataFrame,
    keys: list[str],
    order: list[str],
    limits: JoinLimits = DEFAULT_LIMITS,
) -> DataFrame:
    """Insert or overwrite by key; the last of several new rows per key wins."""
    last = settle(last_per_key(new, keys, order, limits).select(*target.columns))
    kept = lookup_join(target, last.select(*keys), keys, "left_anti", limits)
    return kept.unionByName(last)


def delete_in_list(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Rows whose value is not listed; rows with a null value stay."""
    listed = F.col(column).isin(*values) if values else F.lit(False)
    return df.where(~F.coalesce(listed, F.lit(False)))


def period_is(period: str) -> Column:
    return F.col("Year").eqNullSafe(F.lit(period))


def drop_period(df: DataFrame, period: str) -> DataFrame:
    """Without one period; a null period is no match and stays."""
    return df.where(~period_is(period))


def drop_label(df: DataFrame, column: str, mark: str) -> DataFrame:
    """Without the rows whose label contains a mark."""
    return df.where(~F.col(column).contains(mark))

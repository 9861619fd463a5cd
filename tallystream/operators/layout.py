"""Names, order and types of columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def rename_map(df: DataFrame, names: dict[str, str]) -> tuple[DataFrame, list[str]]:
    """Rename what is there; the names that were not found come back for the log."""
    return df.withColumnsRenamed(names), [n for n in names if n not in df.columns]


def rename_positional(df: DataFrame, names: list[str]) -> DataFrame:
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    return df.toDF(*names)


def schema_report(df: DataFrame, declared: T.StructType) -> list[tuple[str, str]]:
    """Differences between a frame and a declared layout, as (column, what)."""
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in declared.fields}
    found = [(n, "missing") for n in want if n not in have]
    found += [(n, "extra") for n in have if n not in want]
    found += [
        (n, f"{have[n].simpleString()} instead of {want[n].simpleString()}")
        for n in want
        if n in have and have[n] != want[n]
    ]
    return found


def _unreadable(df: DataFrame, declared: T.StructType) -> dict[str, Column]:
    """Per declared column of another type: whether a value is there that the type can't take."""
    return {
        f.name: F.col(f"`{f.name}`").isNotNull() & F.col(f"`{f.name}`").try_cast(f.dataType).isNull()
        for f in declared.fields
        if f.name in df.columns and df.schema[f.name].dataType != f.dataType
    }


def layout_report(df: DataFrame, declared: T.StructType) -> DataFrame:
    """Columns that differ from the declared layout, with the number of values that get lost.

    One aggregate over the frame; columns without a difference are not listed.
    """
    found, lost = schema_report(df, declared), _unreadable(df, declared)
    counts = [F.count_if(c).alias(f"n{i}") for i, c in enumerate(lost.values())]
    place = {name: f"n{i}" for i, name in enumerate(lost)}
    rows = [
        F.struct(
            F.lit(name).alias("column"),
            F.lit(what).alias("difference"),
            (F.col(place[name]) if name in place else F.lit(0)).cast("long").alias("n_unreadable"),
        )
        for name, what in found
    ]
    empty = "array<struct<column:string,difference:string,n_unreadable:bigint>>"
    return df.agg(F.count(F.lit(1)).alias("n"), *counts).select(F.inline(F.array(*rows) if rows else F.array().cast(empty)))


def conform_rejects(df: DataFrame, declared: T.StructType, keys: list[str]) -> DataFrame:
    """What ``conform`` turns into null: keys, column and the text that could not be read."""
    lost = _unreadable(df, declared)
    empty = "array<struct<column:string,raw:string>>"
    each = [
        F.when(bad, F.struct(F.lit(name).alias("column"), F.col(f"`{name}`").cast("string").alias("raw")))
        for name, bad in lost.items()
    ]
    listed = F.filter(F.array(*each), lambda x: x.isNotNull()) if each else F.array().cast(empty)
    return df.select(*keys, F.inline(listed))


def conform(df: DataFrame, declared: T.StructType) -> DataFrame:
    """Declared columns in declared order; missing ones are null, unreadable values too.

    ``conform_rejects`` lists the latter.
    """
    return df.select(
        *[
            (F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(
                f.name
            )
            for f in declared.fields
        ]
    )

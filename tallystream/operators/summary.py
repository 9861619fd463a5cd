"""Averages and column profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tallystream.functions.clean import fill_number, is_digits, percent_fraction
from tallystream.schemas import AVERAGE_KEY, METRICS, TRAILING_PERIOD, YEAR


def averaged_rows(df: DataFrame) -> DataFrame:
    """Rows an average is taken over: no trailing period, and never the average itself."""
    return df.where(~F.col(YEAR).like(TRAILING_PERIOD) & (F.col(YEAR) != AVERAGE_KEY))


def average_row(df: DataFrame) -> DataFrame:
    """The AVERAGE row; metrics are null when there is nothing to average."""
    return averaged_rows(df).agg(*[F.round(F.avg(m), 2).alias(m) for m in METRICS]).select(
        F.lit(AVERAGE_KEY).alias(YEAR), *METRICS
    )


def with_average(df: DataFrame) -> DataFrame:
    """The table with its AVERAGE row renewed; ``df`` is read twice, so settle a costly one first."""
    return df.where(~F.col(YEAR).eqNullSafe(F.lit(AVERAGE_KEY))).unionByName(
        average_row(df), allowMissingColumns=True
    )


def column_profile(texts: DataFrame, columns: list[str], order: list[str]) -> DataFrame:
    """Per text column: whether all values are digits, and whether the first one has a ``%``.

    One pass over the wide frame; the few result columns are unfolded afterwards.
    """
    at = F.struct(*order)
    parts = []
    for i, c in enumerate(columns):
        col = F.col(f"`{c}`")
        parts.append(F.coalesce(F.every(F.coalesce(is_digits(col), F.lit(False))), F.lit(True)).alias(f"d{i}"))
        parts.append(F.min_by(F.coalesce(col, F.lit("")).contains("%"), at).alias(f"p{i}"))
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"d{i}").alias("all_digits"),
                F.coalesce(F.col(f"p{i}"), F.lit(False)).alias("first_has_percent"),
            )
            for i, c in enumerate(columns)
        ]
    )
    return texts.agg(*parts).select(F.inline(rows))


def convert_by_profile(texts: DataFrame, columns: list[str], order: list[str]) -> DataFrame:
    """Text columns as their profile says: all digits to a number, else a first value with ``%`` to
    fractions, else left as text. The profile is one row per column."""
    profile = {r.column: r for r in column_profile(texts, columns, order).collect()}

    def converted(name: str):
        text = F.col(f"`{name}`")
        if profile[name].all_digits:
            return text.try_cast("double")
        return percent_fraction(text) if profile[name].first_has_percent else text

    return texts.withColumns({c: converted(c) for c in columns})


def fill_metrics(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Null and NaN metrics as zero; other columns stay as they are."""
    return df.withColumns({c: fill_number(F.col(c)) for c in (columns or METRICS)})


def union_statements(frames: list[DataFrame]) -> DataFrame:
    """Stack tables by column name; metrics a table lacks are zero, keys stay as they are."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return fill_metrics(stacked, [m for m in METRICS if m in stacked.columns])


def unpivot_metrics(df: DataFrame, ids: list[str]) -> DataFrame:
    return df.unpivot(ids, METRICS, "metric", "v")


def head_rows(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(n)

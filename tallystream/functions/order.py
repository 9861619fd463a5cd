"""Positions as single numbers, so that the latest of a key is a hash aggregate."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

#: More than any long, and less than a thirty-eight digit decimal when multiplied with one.
_RADIX = 10**19
_LEAST = -(2**63)


def _as_long(column: Column, kind: T.DataType) -> Column | None:
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("long")
    if isinstance(kind, T.IntegralType):
        return column.cast("long")
    return None


def rank(schema: T.StructType, first: str, second: str | None = None) -> Column:
    """A number that orders rows by one or two whole-number or time columns; nulls come first."""
    parts = []
    for name in [first] + ([second] if second else []):
        part = _as_long(F.col(name), schema[name].dataType)
        if part is None:
            raise TypeError(f"{name} is no time or whole number")
        parts.append(F.coalesce(part, F.lit(_LEAST)))
    if second is None:
        return parts[0]
    high = parts[0].cast("decimal(19,0)") * F.lit(str(_RADIX)).cast("decimal(20,0)")
    return (high.cast("decimal(38,0)") + parts[1].cast("decimal(19,0)")).cast("decimal(38,0)")

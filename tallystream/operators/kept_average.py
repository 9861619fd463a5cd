"""An average that is kept up by differences.

Per metric the exact sum and the count of the rows an average is taken over are kept. A batch of
changes moves them by its rows as they were and as they are now; no other row is looked at. Sums are
decimals with ten places, so neither the order of summing nor the number of steps shows in them,
and the mean is rounded from the exact quotient, half away from zero.

A metric that is null or no number doesn't count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallystream.operators.summary import averaged_rows
from tallystream.schemas import AVERAGE_KEY, METRICS, YEAR

#: One row per metric.
SUMS = "metric string, total decimal(38,10), n long"


def sums_of(rows: DataFrame, sign: int = 1) -> DataFrame:
    """Sums and counts of the rows an average is taken over, in one pass."""
    value = {m: F.col(m).try_cast("decimal(28,10)") for m in METRICS}
    sums = [F.struct(F.sum(v).alias("total"), F.count(v).alias("n")).alias(m) for m, v in value.items()]
    rows = averaged_rows(rows).agg(*sums)
    each = F.array(*[F.struct(F.lit(m).alias("metric"), f"{m}.total", f"{m}.n") for m in METRICS])
    total = F.coalesce(F.col("total"), F.lit(0).cast("decimal(38,10)")) * F.lit(sign)
    return rows.select(F.inline(each)).select("metric", total.cast("decimal(38,10)").alias("total"), (F.col("n") * sign).alias("n"))


def sums_after(sums: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """The sums once the rows ``before`` have become the rows ``after``."""
    moved = sums.unionByName(sums_of(before, -1)).unionByName(sums_of(after))
    total = F.sum("total").cast("decimal(38,10)").alias("total")
    return moved.groupBy("metric").agg(total, F.sum("n").alias("n"))


def average_of(sums: DataFrame) -> DataFrame:
    """The AVERAGE row; metrics are null when there is nothing to average."""
    # total / n to two places: (2 |total| 100 + n) div (2 n), with total in units of its last place.
    units = F.expr("cast(abs(total) * 10000000000 as decimal(38,0))")
    wide = sums.withColumns({"_units": units, "_n": F.col("n").cast("decimal(28,0)") * F.lit(100_000_000).cast("decimal(9,0)")})
    hundredths = F.expr("(cast(_units * 2 + _n as decimal(38,0))) div (_n * 2)")
    mean = F.when(F.col("n") > 0, F.signum("total") * hundredths / F.lit(100.0))
    picked = [F.max(F.when(F.col("metric") == m, mean)).cast("double").alias(m) for m in METRICS]
    return wide.agg(*picked).select(F.lit(AVERAGE_KEY).alias(YEAR), *METRICS)

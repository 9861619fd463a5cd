"""Numbers without gaps, in order, without gathering all rows in one task."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F

from tallystream.session import settle

#: ``monotonically_increasing_id`` has the partition above these bits and the row within below.
_ROW_BITS = 33


def dense_ids(rows: DataFrame, name: str, order: list[Column | str], after: int = 0) -> DataFrame:
    """The rows with a column ``name``: after + 1, after + 2, ... in the given order.

    Rows are split into ranges of the order, sorted there and written down once; each range's size
    is counted, and a row's number is the sum of the sizes before its range and its place in it.
    The driver gets one count per range. Rows that tie are put in an order of their contents, so
    the numbers are the same however the rows were split before; rows that are equal throughout
    may get either's number.
    """
    contents = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    keyed = rows.withColumns({f"_o{i}": c for i, c in enumerate(order)} | {"_h": F.xxhash64(contents)})
    by = [*[f"_o{i}" for i in range(len(order))], "_h"]
    # The last key only sorts equal hashes of different rows; it isn't needed to deal them out.
    text = keyed.withColumn("_t", F.to_json(contents))
    placed = settle(text.repartitionByRange(*by).sortWithinPartitions(*by, "_t").drop(*by, "_t"))
    spot = placed.withColumn("_spot", F.monotonically_increasing_id())
    sizes = sorted(
        (r.p, r.n)
        for r in spot.groupBy(F.shiftright("_spot", _ROW_BITS).cast("int").alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()
    )
    starts = accumulate((n for _, n in sizes), initial=after)
    before = rows.sparkSession.createDataFrame([(p, s) for (p, _), s in zip(sizes, starts)], "_p int, _start long")
    numbered = spot.withColumn("_p", F.shiftright("_spot", _ROW_BITS).cast("int")).join(F.broadcast(before), "_p")
    place = F.col("_spot").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return numbered.withColumn(name, F.col("_start") + place + 1).drop("_p", "_start", "_spot")

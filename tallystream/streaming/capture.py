"""Changes captured from a stream of row versions as they come.

The last image of every key is keyed state without expiry. A version is an INSERT where the key has
no row, an UPDATE where its image differs from the row's, a DELETE where it says that the row is
gone; a version that changes nothing gives nothing. Within a key versions are taken in order of
their place. One at or before the last place taken was delivered before, or came too late, and is
passed over; so as long as a key's versions arrive in order the records are the same however the
stream is cut into batches, and the same as ``capture`` gives on the whole.

Images travel and are kept as JSON text, which the JVM writes and reads; the Python side only
compares texts. A batch's versions of one key are sorted in one task's memory, which the source's
limit on a batch bounds. For state larger than memory set the RocksDB state store in the session.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tallystream.schemas import DELETE, INSERT, UPDATE

_STATE = "place long, image string"


def _prepared(versions: DataFrame, keys: list[str], place: str, at: str, gone: str) -> tuple[DataFrame, T.StructType]:
    values = [c for c in versions.columns if c not in (*keys, place, at, gone)]
    layout = T.StructType([versions.schema[v] for v in values])
    image = F.to_json(F.struct(*values), {"ignoreNullFields": "false"}) if values else F.lit("{}")
    there = F.when(~F.coalesce(F.col(gone), F.lit(False)), image)
    rows = versions.where(F.col(place).isNotNull())
    return rows.select(*keys, F.col(place).cast("long").alias("place"), F.col(at).alias("at"), there.alias("image")), layout


def _records(changes: DataFrame, keys: list[str], layout: T.StructType) -> DataFrame:
    """(audit_id, operation_type, changed_at, keys, values): the new image, or the old one of a deletion."""
    parsed = changes.select(
        F.col("place").alias("audit_id"),
        "operation_type",
        F.col("at").alias("changed_at"),
        *keys,
        F.inline(F.array(F.from_json("image", layout))),
    )
    return parsed


def capture(versions: DataFrame, keys: list[str], place: str, at: str, gone: str) -> DataFrame:
    """Records of a stored sequence of versions: one window over each key, which spills.

    Of versions with one key and place the one with the smallest image counts, a deletion first.
    """
    rows, layout = _prepared(versions, keys, place, at, gone)
    by = Window.partitionBy(*keys).orderBy("place", F.col("image").asc_nulls_first())
    one = rows.withColumn("_last", F.lag("place").over(by)).where("_last is null or _last <> place")
    before = one.withColumn("_before", F.lag("image").over(Window.partitionBy(*keys).orderBy("place")))
    kind: Column = (
        F.when(F.col("_before").isNull(), INSERT).when(F.col("image").isNull(), DELETE).otherwise(UPDATE)
    )
    changed = before.where(~F.col("image").eqNullSafe(F.col("_before")))
    return _records(
        changed.select(*keys, "place", "at", kind.alias("operation_type"), F.coalesce("image", "_before").alias("image")),
        keys,
        layout,
    )


def capture_stream(versions: DataFrame, keys: list[str], place: str, at: str, gone: str) -> DataFrame:
    """Records of a stream of versions, one at a time as they change the row.

    ``place`` is a whole number that orders the versions of a key and is the audit id of its record,
    ``at`` its time, ``gone`` true for a row that was removed; all other columns are the image. Null
    keys are keys, equal to each other. A version without a place is passed over.
    """
    rows, layout = _prepared(versions, keys, place, at, gone)
    kinds = [rows.schema[k] for k in keys]
    out = T.StructType(
        [*kinds, T.StructField("place", T.LongType()), rows.schema["at"], T.StructField("operation_type", T.StringType()),
         T.StructField("image", T.StringType())]
    )

    def step(key: tuple, parts: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, image = state.get if state.exists else (None, None)
        found = pd.concat([p[["place", "at", "image"]] for p in parts], ignore_index=True)
        found = found.sort_values(["place", "image"], na_position="first", kind="stable")
        records = []
        for at_place, time, text in zip(found["place"].tolist(), found["at"], found["image"]):
            text = text if isinstance(text, str) else None
            if last is not None and at_place <= last:
                continue
            if text != image:
                kind = INSERT if image is None else DELETE if text is None else UPDATE
                records.append((*key, at_place, time, kind, image if text is None else text))
            last, image = at_place, text
        state.update((last, image))
        yield pd.DataFrame(records, columns=out.names)

    changes = rows.groupBy(*keys).applyInPandasWithState(step, out, _STATE, "append", GroupStateTimeout.NoTimeout)
    return _records(changes, keys, layout)

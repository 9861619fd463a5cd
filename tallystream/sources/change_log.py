"""A keyed table as a state and a log of changes that are not in it yet.

A batch of changes is written to a part of the log of its own; nothing else is written, however
large the table is. A scheduled job calls ``fold``, which writes the state with the log's parts in
it as the next version and then a note that names the version and the parts. Readers take the
version noted last and the parts it doesn't name, so a fold that stopped half way is not seen.

The contents are those of one replay of all changes in order of ``(changed_at, audit_id)``: they
don't depend on how changes were cut into batches, who wrote those, in which order they came, nor
when they were folded (see ``operators.marks``). A change whose audit id was applied before is
refused and counted, so a batch or a record may be written any number of times, also under a batch
number that was used before. Several writers may append; one job folds.

``clean`` removes parts and versions that neither the last note nor the one before needs.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tallystream.operators.fold import IGNORE
from tallystream.operators.joins import DEFAULT_LIMITS, JoinLimits
from tallystream.operators.marks import (
    APPLIED,
    Moved,
    State,
    initial_state,
    marks_layout,
    merge,
    only_new,
    rows_layout,
    settle_until,
    shown,
)
from tallystream.operators.kept_average import SUMS, average_of, sums_after, sums_of
from tallystream.schemas import AVERAGE_KEY, METRICS, YEAR
from tallystream.sources.folders import children, exists, remove

_NOTES = (
    "version long, parts array<string>, n_changes long, n_repeated long, n_late long, settled_until timestamp"
)


class ChangeLog:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: T.StructType,
        keys: list[str],
        on_insert: str = IGNORE,
        limits: JoinLimits = DEFAULT_LIMITS,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = schema
        self.keys = keys
        self.on_insert = on_insert
        self.limits = limits
        change = "operation_type string, changed_at timestamp, audit_id long"
        self._log_schema = T.StructType([*T.StructType.fromDDL(change).fields, *schema.fields])
        #: Whether the table has an average, whose sums are written with each version.
        self.averaged = {YEAR, *METRICS} <= set(schema.names)

    def notes(self) -> DataFrame:
        """One row per version: the parts in it, and how many changes were applied, refused as repeated,
        and refused as later than ``settled_until`` allows."""
        try:
            return self.spark.read.schema(_NOTES).parquet(f"{self.root}/notes")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _NOTES)

    def _noted(self):
        return self.notes().orderBy(F.desc("version")).first()

    def _state(self, noted) -> State:
        if not noted:
            return initial_state(self.spark, self.schema, self.keys)
        folder = f"{self.root}/state/version={noted.version}"
        layouts = (rows_layout(self.schema), marks_layout(self.schema, self.keys), APPLIED)
        return State(
            *[self.spark.read.schema(s).parquet(f"{folder}/{n}") for n, s in zip(("rows", "marks", "applied"), layouts)]
        )

    def _sums(self, noted) -> DataFrame:
        if not noted:
            return self.spark.createDataFrame([], SUMS)
        return self.spark.read.schema(SUMS).parquet(f"{self.root}/state/version={noted.version}/sums")

    def _write(self, version: int, state: State, sums: DataFrame, parts: list[str], counts: tuple, settled) -> None:
        folder = f"{self.root}/state/version={version}"
        for name in ("rows", "marks", "applied"):
            getattr(state, name).write.mode("overwrite").parquet(f"{folder}/{name}")
        if self.averaged:
            sums.coalesce(1).write.mode("overwrite").parquet(f"{folder}/sums")
        note = self.spark.createDataFrame([(version, parts, *counts, settled)], _NOTES)
        note.coalesce(1).write.mode("append").parquet(f"{self.root}/notes")

    def load_initial(self, rows: DataFrame) -> None:
        """First contents of an empty table, older than any change.

        With one row per key, several rows of a key stop the load. Rows with a null key match no change.
        """
        if self._noted():
            raise ValueError("the table already has contents")
        if self.on_insert == IGNORE:
            several = rows.dropna(subset=self.keys).groupBy(*self.keys).count().where("count > 1").first()
            if several:
                raise ValueError(f"several rows for key {tuple(several)[:-1]}")
        state = initial_state(self.spark, self.schema, self.keys, rows)
        self._write(1, state, sums_of(rows) if self.averaged else None, [], (0, 0, 0), None)

    def append(self, changes: DataFrame, batch_id: int = 0, writer: str = "batch") -> None:
        """Add a batch of changes, in any order. ``batch_id`` and ``writer`` only name it."""
        part = f"{self.partition_of(writer)}-{batch_id}-{uuid.uuid4().hex}"
        changes.select(*self._log_schema.names).write.parquet(f"{self.root}/log/part={part}")

    @staticmethod
    def partition_of(writer: str) -> str:
        """A writer's name as part of the name of a folder."""
        return "".join(c if c.isalnum() else f"_{ord(c):x}_" for c in writer)

    def _parts(self) -> list[str]:
        """Parts of the log that were written to their end."""
        names = [n for n in children(self.spark, f"{self.root}/log") if n.startswith("part=")]
        return [n for n in names if exists(self.spark, f"{self.root}/log/{n}/_SUCCESS")]

    def _pending(self, parts: list[str]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], self._log_schema)
        return self.spark.read.schema(self._log_schema).parquet(*[f"{self.root}/log/{p}" for p in parts])

    @staticmethod
    def _in_time(noted) -> Column:
        if not noted or not noted.settled_until:
            return F.lit(True)
        return F.coalesce(F.col("changed_at") >= F.lit(noted.settled_until), F.lit(False))

    def _after(self, noted, parts: list[str]) -> tuple[State, Moved, DataFrame]:
        """State with some parts of the log in it, the rows they moved, and repeated ids among them."""
        state = self._state(noted)
        fresh, known = only_new(self._pending(parts).where(self._in_time(noted)), state.applied, self.limits)
        return *merge(state, fresh, self.keys, self.on_insert, self.limits), known

    def _waiting(self) -> tuple:
        noted = self._noted()
        folded = set(noted.parts) if noted else set()
        return noted, [p for p in self._parts() if p not in folded]

    def read(self) -> DataFrame:
        """The table as of all changes in the log."""
        noted, parts = self._waiting()
        state = self._after(noted, parts)[0] if parts else self._state(noted)
        return shown(state, self.schema.names)

    def fold(self, settled: str | None = None) -> bool:
        """Write the state with the log in it as the next version; False where the log has nothing new.

        ``settled`` is a time before which no change will come any more. What only older changes
        could need is dropped, and an older change that comes all the same is refused as late.
        """
        noted, parts = self._waiting()  # parts that arrive meanwhile wait
        if not parts and settled is None:
            return False
        state, moved, known = self._after(noted, parts)
        sums = sums_after(self._sums(noted), moved.before, moved.after) if self.averaged else None
        repeated = known.agg(F.sum(F.col("n") - (~F.col("before")).cast("int"))).first()[0] or 0
        n, n_in_time = self._pending(parts).agg(F.count(F.lit(1)), F.count_if(self._in_time(noted))).first()
        until = noted.settled_until if noted else None
        if settled is not None:
            wanted = self.spark.range(1).select(F.greatest(F.lit(settled).cast("timestamp"), F.lit(until))).first()[0]
            until, state = wanted, settle_until(state, F.lit(wanted))
        there = set(self._parts())
        folded = [p for p in noted.parts if p in there] if noted else []
        counts = (n_in_time - repeated, repeated, n - n_in_time)
        self._write((noted.version if noted else 0) + 1, state, sums, folded + parts, counts, until)
        return True

    def clean(self) -> None:
        """Remove versions before the last two, and parts that were in the one before the last already."""
        last = [r for r in self.notes().orderBy(F.desc("version")).limit(2).collect()]
        if len(last) < 2:
            return
        for part in last[1].parts:
            remove(self.spark, f"{self.root}/log/{part}")
        for name in children(self.spark, f"{self.root}/state"):
            if int(name.partition("=")[2]) < last[1].version:
                remove(self.spark, f"{self.root}/state/{name}")

    def average(self) -> DataFrame:
        """The AVERAGE row as of all changes: the sums of the last version, moved by the rows that changes
        since then concern."""
        noted, parts = self._waiting()
        sums = self._sums(noted)
        if parts:
            moved = self._after(noted, parts)[1]
            sums = sums_after(sums, moved.before, moved.after)
        return average_of(sums)

    def read_with_average(self) -> DataFrame:
        noted, parts = self._waiting()
        if not parts:
            rows, sums = shown(self._state(noted), self.schema.names), self._sums(noted)
        else:
            state, moved, _ = self._after(noted, parts)
            rows, sums = shown(state, self.schema.names), sums_after(self._sums(noted), moved.before, moved.after)
        # An AVERAGE row that was loaded is renewed.
        return rows.where(~F.col(YEAR).eqNullSafe(F.lit(AVERAGE_KEY))).unionByName(average_of(sums), allowMissingColumns=True)

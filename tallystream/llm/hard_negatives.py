"""Hard negatives of anchor vectors, by the threshold algorithm over sorted component lists.

Vectors become whole numbers, floor(256 x), and lie in blocks: a block holds its rows' components
and, for every dimension, the rows in ascending order of that component. For an anchor the lists
are read from the end that its component's sign prefers, all to one depth. Each row met is scored
at once by its whole inner product. A row not met yet can't score more than the sum of what the
lists show next; once that sum is strictly below the kth best of every window that is looked
for (or below the window itself), the rest of the block is not read. Strictly, because a row of
equal score may have the smaller id.

The anchors of a pack are looked up in a block together: what their lists show next at each depth is
one small product, and tells who needs the block not at all, a few rows of it or most of them.
Who needs most gets all rows' scores by one product, which is cheaper than reading lists to their ends.

Anchors travel in packs, once to each group of blocks, and so do blocks to their own; a task keeps its
blocks, goes through them with one pack at a time and returns its best rows only. The best of all groups
are ranked by a window with one limit per task before the shuffle. Blocks and packs are dealt by the
number of their group, not joined, so no vector is broadcast or collected whatever Spark's limits are.

Rows with a null label, a null vector or a null or non-finite component take no part. Rows are
told apart by their place, not by their id: of rows with equal ids each is a row of its own, and
an anchor's own row alone is left out. Equal scores go by id, null ids last. Vectors of another
length than the anchor's can't be compared with it. A vector without components scores 0. An
empty table gives no rows. Scores are exact whatever the size of the components; one that is
returned and doesn't fit 64 bits stops the job.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tallystream.llm.common import fields, small_batches, stored

#: Whole numbers up to this are exact in a double, and up to the other in a float.
EXACT = 1 << 53
EXACT_FLOAT = 1 << 24
SCALE = 256.0
#: Rows whose scores are in memory together, and blocks that a task keeps, as long as there may be more groups.
TOGETHER, KEPT = 4096, 16


@dataclass(frozen=True)
class Mining:
    """What is looked for, and how work is dealt out.

    ``positives`` per anchor and ``negatives`` per positive. A negative's score lies between
    ``low`` and 100 hundredths of the positive's. ``block_rows`` rows are sorted together, packs
    have ``pack_rows`` anchors, and blocks form at most ``groups`` groups, each of which gets all
    packs. Sorted access begins with ``first_depth`` rows a list and doubles.
    """

    positives: int = 5
    negatives: int = 5
    low: int = 80
    block_rows: int = 4096
    pack_rows: int = 256
    groups: int = 4096
    first_depth: int = 16


_BLOCK = fields(
    ("block", T.LongType()),
    ("dims", T.IntegerType()),
    ("ids", T.BinaryType()),
    ("known", T.BinaryType()),
    ("labels", T.BinaryType()),
    ("components", T.BinaryType()),
    ("lists", T.BinaryType()),
)
_ANCHOR = fields(
    ("anchor", T.LongType()),
    ("anchor_id", T.LongType()),
    ("label", T.LongType()),
    ("dims", T.IntegerType()),
    ("components", T.BinaryType()),
)
_FOUND = fields(
    ("anchor", T.LongType()),
    ("positive", T.IntegerType()),
    ("score", T.LongType()),
    ("id", T.LongType()),
    ("place", T.LongType()),
)
#: Rows of a block at most: a row's place is its block's number shifted by this, and its row.
_ROW_BITS = 20


def _batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    kinds = {T.LongType(): pa.int64(), T.IntegerType(): pa.int32(), T.BinaryType(): pa.binary()}
    columns = zip(*rows) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[f.dataType]) for c, f in zip(columns, schema)], schema.names)


def usable(embeddings: DataFrame, label: Column | None = None) -> DataFrame:
    """Rows that take part, with the label that counts."""
    x = F.col("embedding").cast("array<double>")
    odd = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = embeddings.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~odd)
    label = F.col("label") if label is None else label
    return rows.select(F.col("vec_id").cast("long").alias("id"), label.cast("long").alias("label"), x.alias("x"))


def pack_blocks(rows: DataFrame, block_rows: int) -> DataFrame:
    """Stored blocks of the rows, as each task reads them; rows in a block are in order of id."""

    def packed(number: int, ids: list, labels: list, vectors: list[np.ndarray]) -> tuple:
        order = sorted(range(len(ids)), key=lambda r: (ids[r] is None, ids[r] or 0))
        known = np.array([ids[r] is not None for r in order], np.uint8)
        values = np.floor(np.array([vectors[r] for r in order]).reshape(len(order), -1) * SCALE)
        lists = np.argsort(values, axis=0, kind="stable").T.astype("<u4")
        own_ids = np.array([ids[r] or 0 for r in order], "<i8")
        own_labels = np.array([labels[r] for r in order], "<i8")
        parts = (own_ids, known, own_labels, values.astype("<f8"), lists)
        return number, values.shape[1], *[p.tobytes() for p in parts]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 16
        held: dict[int, tuple[list, list, list]] = {}
        for batch in batches:
            ids, labels = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            offsets = batch.column(2).offsets.to_numpy()
            flat = batch.column(2).values.to_numpy(zero_copy_only=False)
            for row, (a, b) in enumerate(zip(offsets, offsets[1:])):
                some = held.setdefault(int(b - a), ([], [], []))
                for column, value in zip(some, (ids[row], labels[row], flat[a:b].copy())):
                    column.append(value)
                if len(some[0]) == block_rows:
                    yield _batch([packed(number, *held.pop(int(b - a)))], _BLOCK)
                    number += 1
        for some in held.values():
            yield _batch([packed(number, *some)], _BLOCK)
            number += 1

    if not 0 < block_rows <= 1 << _ROW_BITS:
        raise ValueError(f"a block has up to {1 << _ROW_BITS} rows")
    return stored(rows.mapInArrow(pack, _BLOCK), "vector-blocks")


class Block:
    """Rows of a block and its sorted lists."""

    def __init__(self, row: dict):
        self.number, self.dims = row["block"], row["dims"]
        self.known = np.frombuffer(row["known"], np.uint8)
        self.ids, self.labels = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i8")
        self.rows = len(self.ids)
        self.values = np.frombuffer(row["components"], "<f8").reshape(self.rows, self.dims)
        self.lists = np.frombuffer(row["lists"], "<u4").reshape(self.dims, self.rows)
        self.most = float(np.abs(self.values).max(initial=0.0))
        self._sorted = self._floats = None

    @property
    def floats(self) -> np.ndarray:
        if self._floats is None:
            self._floats = self.values.astype(np.float32)
        return self._floats

    @property
    def shown(self) -> np.ndarray:
        """Components in the order of the lists."""
        if self._sorted is None:
            self._sorted = np.take_along_axis(self.values.T, self.lists.astype(np.int64), 1)
        return self._sorted

    def place(self, row: int) -> int:
        return self.number << _ROW_BITS | int(row)

    def id(self, row: int) -> int | None:
        return int(self.ids[row]) if self.known[row] else None


def anchors_of(blocks: DataFrame, every: int) -> DataFrame:
    """Rows whose id is divisible by ``every``, stored one by one."""

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row)
                chosen = np.flatnonzero((block.ids % every == 0) & (block.known == 1))
                yield _batch(
                    [(block.place(r), block.id(r), int(block.labels[r]), block.dims, block.values[r].tobytes()) for r in chosen],
                    _ANCHOR,
                )

    return stored(blocks.mapInArrow(take, _ANCHOR), "anchors")


@dataclass
class Search:
    """What one anchor looks for: the best ``k`` rows of each window of scores.

    ``same`` tells whether rows have to share the anchor's label or must not. ``best`` holds, per
    window, what was found so far as (-score, id is null, id, place), best first.
    """

    place: int
    label: int
    vector: np.ndarray
    windows: list[tuple[int | float, int | float]]
    same: bool
    k: int

    def __post_init__(self):
        self.most = float(np.abs(self.vector).max(initial=0.0))
        self.best: list[list[tuple]] = [[] for _ in self.windows]
        self.lowest = min(w[0] for w in self.windows)
        self.highest = max(w[1] for w in self.windows)

    def done(self, limit) -> bool:
        """Whether no row that scores at most ``limit`` can still change a window."""
        return all(
            limit < low or (len(best) == self.k and limit < -best[-1][0]) for (low, _), best in zip(self.windows, self.best)
        )

    @property
    def bar(self) -> int | float:
        """The least score that can still change a window; as a number that a double holds."""
        bars = (max(low, -best[-1][0]) if len(best) == self.k else low for (low, _), best in zip(self.windows, self.best))
        return _within_exact(min(bars))

    def offer(self, block: Block, rows: np.ndarray, scores: np.ndarray) -> None:
        fits = (block.labels[rows] == self.label) == self.same
        fits &= (scores >= self.lowest) & (scores <= self.highest)
        if not fits.any():
            return
        rows, scores = rows[fits], scores[fits]
        for n, (low, high) in enumerate(self.windows):
            best = self.best[n]
            inside = (scores >= (max(low, -best[-1][0]) if len(best) == self.k else low)) & (scores <= high)
            in_rows, in_scores = rows[inside], scores[inside]
            if len(in_rows) > 4 * self.k:  # all that ties with the kth best stays; the anchor itself may be among them
                edge = np.sort(in_scores)[-self.k - 1]
                in_rows, in_scores = in_rows[in_scores >= edge], in_scores[in_scores >= edge]
            found = [
                (-int(s), not block.known[r], int(block.ids[r]), block.place(r))
                for r, s in zip(in_rows.tolist(), in_scores.tolist())
                if block.place(r) != self.place
            ]
            if found:
                self.best[n] = sorted(best + found)[: self.k]


def _within_exact(score: int | float) -> int | float:
    return min(max(score, -EXACT), EXACT)


def _whole(values: np.ndarray) -> np.ndarray:
    """The same numbers as Python's whole numbers, which have no largest one."""
    return np.array([int(v) for v in values.ravel()], object).reshape(values.shape)


def search_block(search: Search, block: Block, first_depth: int = 16) -> int:
    """Threshold algorithm over one block; returns how many rows were scored."""
    vector = search.vector
    use = np.flatnonzero(vector)
    values, weights = block.values, vector
    if block.dims * search.most * block.most >= EXACT:
        values, weights = _whole(values), _whole(vector)
    if not len(use):  # every score is 0
        search.offer(block, np.arange(block.rows), np.zeros(block.rows))
        return block.rows
    rising = vector[use] > 0
    shown = block.shown
    unmet = np.ones(block.rows, bool)
    depth, stop, scored = 0, min(first_depth, block.rows), 0
    while True:
        met = np.zeros(block.rows, bool)
        met[block.lists[use[rising], block.rows - stop : block.rows - depth]] = True
        met[block.lists[use[~rising], depth:stop]] = True
        rows = np.flatnonzero(met & unmet)
        unmet[rows] = False
        scored += len(rows)
        search.offer(block, rows, values[rows] @ weights)
        if stop == block.rows or scored == block.rows:
            return scored
        ahead = np.where(rising, shown[use, block.rows - 1 - stop], shown[use, stop])
        limit = ahead @ weights[use] if values is block.values else _whole(ahead) @ weights[use]
        if search.done(limit):
            return scored
        depth, stop = stop, min(2 * stop, block.rows)


class Pack:
    """Anchors of one length that are looked up together."""

    def __init__(self, searches: list[Search]):
        self.searches = searches
        self.vectors = np.array([s.vector for s in searches]).reshape(len(searches), -1)
        self.floats = self.vectors.astype(np.float32)
        self.rising, self.falling = np.maximum(self.vectors, 0), np.minimum(self.vectors, 0)
        self.used = np.count_nonzero(self.vectors, axis=1)
        self.most = max(s.most for s in searches)
        self.labels = np.array([s.label for s in searches])
        self.highest = np.array([_within_exact(s.highest) for s in searches], float)
        self.bars = np.array([s.bar for s in searches], float)

    def search(self, block: Block, first_depth: int) -> int:
        """Threshold algorithm of all anchors over one block; returns how many rows were scored."""
        most = block.dims * self.most * block.most
        if most >= EXACT:
            return sum(search_block(search, block, first_depth) for search in self._each(range(len(self.searches))))
        depths, depth = [0], first_depth
        while depth < block.rows:
            depths.append(depth)
            depth *= 2
        at = np.array(depths)
        ahead = self.rising @ block.shown[:, block.rows - 1 - at] + self.falling @ block.shown[:, at]
        stops = ahead < self.bars[:, None]
        stop = np.where(stops.any(axis=1), at[stops.argmax(axis=1)], block.rows)
        few = stop * self.used < block.rows // 2
        scored = sum(search_block(search, block, first_depth) for search in self._each(np.flatnonzero(few & (stop > 0))))
        rest = np.flatnonzero(~few)
        if not len(rest):
            return scored
        small = most < EXACT_FLOAT
        vectors, values = (self.floats[rest], block.floats) if small else (self.vectors[rest], block.values)
        for begin in range(0, block.rows, TOGETHER):
            self._offer(block, begin, rest, vectors @ values[begin : begin + TOGETHER].T)
        return scored + len(rest) * block.rows

    def _offer(self, block: Block, begin: int, anchors: np.ndarray, scores: np.ndarray) -> None:
        who, rows = np.nonzero(scores >= self.bars[anchors].astype(scores.dtype)[:, None])
        scores = scores[who, rows].astype(float)
        fits = scores <= self.highest[anchors[who]]
        same = self.searches[0].same
        fits &= (block.labels[begin + rows] == self.labels[anchors[who]]) == same
        who, rows, scores = who[fits], begin + rows[fits], scores[fits]
        bounds = np.flatnonzero(np.concatenate(([True], who[1:] != who[:-1], [True]))) if len(who) else []
        for a, b in zip(bounds, bounds[1:]):
            for search in self._each([anchors[who[a]]]):
                search.offer(block, rows[a:b], scores[a:b])

    def _each(self, anchors: Iterable[int]) -> Iterator[Search]:
        """The anchors one by one, whose bars are then taken anew."""
        for n in anchors:
            yield self.searches[n]
            self.bars[n] = self.searches[n].bar


def _dealt(blocks: DataFrame, anchors: DataFrame, mining: Mining) -> DataFrame:
    """Each group's blocks, with a pack of -1, and after them all packs of anchors."""
    n, tasks = blocks.agg(F.count("*"), F.max(F.shiftright("block", 16)) + 1).first()
    parts = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = max(1, min(n, mining.groups, max(parts, -(-n // KEPT))))
    # Blocks are numbered within tasks that have about the same number of them.
    place = F.shiftright("block", 16) + F.col("block").bitwiseAND(65535) * (tasks or 1)
    held = blocks.select(
        F.pmod(place, F.lit(groups)).cast("int").alias("group"), F.lit(-1).cast("long").alias("pack"), F.lit(None).cast("binary").alias("anchors"),
        *_BLOCK.names,
    )
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64())}
    layout = pa.schema([(f.name, kinds[f.dataType.simpleString()]) for f in anchors.schema])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in _of_size(batches, mining.pack_rows, layout):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema) as out:
                out.write_table(batch)
            yield pa.RecordBatch.from_pydict({"pack": pa.array([number]), "anchors": pa.array([sink.getvalue().to_pybytes()])})
            number += 1

    packs = stored(anchors.mapInArrow(pack, "pack long, anchors binary"), "anchor-packs")
    sent = packs.select(
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), "pack", "anchors",
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in _BLOCK],
    )
    return held.union(sent).repartitionById(groups, "group").sortWithinPartitions("group", "pack", "block")


def _of_size(batches: Iterable[pa.RecordBatch], size: int, layout: pa.Schema) -> Iterator[pa.Table]:
    held = pa.Table.from_batches([], layout)
    for batch in batches:
        held = pa.concat_tables([held, pa.Table.from_batches([batch]).cast(layout)])
        while held.num_rows >= size:
            yield held.slice(0, size).combine_chunks()
            held = held.slice(size)
    if held.num_rows:
        yield held.combine_chunks()


def _searched(dealt: DataFrame, same: bool, mining: Mining) -> DataFrame:
    """The best rows of every anchor and window, of each group of blocks."""
    k = mining.positives if same else mining.negatives

    def window(score: int) -> tuple[int | float, int | float]:
        low = -(-mining.low * score // 100)
        return (low, score) if low <= score else (math.inf, -math.inf)

    def opened(data: bytes) -> dict[int, Pack]:
        searches: dict[int, list[Search]] = {}
        for row in pa.ipc.open_stream(data).read_all().to_pylist():
            windows = [(-math.inf, math.inf)] if same else [window(s) for s in row["scores"]]
            search = Search(row["anchor"], row["label"], np.frombuffer(row["components"], "<f8"), windows, same, k)
            searches.setdefault(row["dims"], []).append(search)
        return {dims: Pack(some) for dims, some in searches.items()}

    def results(packs: Iterable[Pack]) -> pa.RecordBatch:
        return _batch(
            [
                (search.place, n, -minus, None if unknown else id_, place)
                for pack in packs
                for search in pack.searches
                for n, best in enumerate(search.best)
                for minus, unknown, id_, place in best
            ],
            _FOUND,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, blocks = None, []
        for batch in batches:
            groups, numbers, anchors = (batch.column(c).to_pylist() for c in ("group", "pack", "anchors"))
            rows = batch.select(_BLOCK.names)
            for row, number in enumerate(numbers):
                if groups[row] != group:
                    group, blocks = groups[row], []
                if number < 0:
                    blocks.append(Block(rows.slice(row, 1).to_pylist()[0]))
                    continue
                packs = opened(anchors[row])
                for block in blocks:
                    if block.dims in packs:
                        packs[block.dims].search(block, mining.first_depth)
                yield results(packs.values())

    return dealt.mapInArrow(run, _FOUND)


def _first(found: DataFrame, k: int) -> DataFrame:
    """The k best of each anchor and window, numbered from 1."""
    by = Window.partitionBy("anchor", "positive").orderBy(F.desc("score"), F.asc_nulls_last("id"), "place")
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def hard_negatives(
    embeddings: DataFrame, every: int = 100, label: Column | None = None, mining: Mining | None = None
) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are rows whose vec_id is divisible by ``every``; their positives are the best scored
    other rows of the same label. For each, the best scored rows of other labels whose score
    lies within ``mining.low`` to 100 hundredths of the positive's are its negatives. ``label``
    replaces the label column. Where scores are negative no row lies within. See the module for
    nulls, ties and repeated rows; columns other than vec_id, embedding and label are not read.
    """
    mining = mining or Mining()
    small_batches(embeddings.sparkSession)
    blocks = pack_blocks(usable(embeddings, label), mining.block_rows)
    anchors = anchors_of(blocks, every)
    best = _first(_searched(_dealt(blocks, anchors, mining), True, mining), mining.positives)
    positives = stored(
        best.select("anchor", F.col("rank").alias("n"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")),
        "positives",
    )
    scores = positives.groupBy("anchor").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("n", "positive_score"))), lambda p: p["positive_score"]).alias("scores")
    )
    scored = anchors.join(scores.hint("merge"), "anchor")
    near = _first(_searched(_dealt(blocks, scored, mining), False, mining), mining.negatives)
    found = near.select(
        "anchor", (F.col("positive") + 1).alias("n"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    return (
        found.join(positives, ["anchor", "n"])
        .join(anchors.select("anchor", "anchor_id"), "anchor")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )

"""Best-fit packing of token sequences, improved by swaps between underfull bins.

Documents become token ids and are cut into pieces of at most ``size`` ids. A piece of full size is
a sequence of its own. The others are dealt to groups of bounded size by a hash of their number, so
every group has about the same mixture of lengths; each group is packed by itself:

* best fit, longest piece first, over bins kept by the room they have;
* local search among bins with room left: one piece moves to another bin, one is exchanged for
  one, or two for one, whenever that raises the sum of squared fills: the fuller bin gets fuller,
  the other emptier, until it has nothing left and goes.

The pieces of bins that still have room are dealt anew, so what each group could not fill is
packed with the rest of other groups, round after round while bins go. No group ever holds
more than ``group_pieces`` pieces in expectation, whatever the table's size.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tallystream.llm.common import fields, portions, stored, text_or_empty
from tallystream.llm.token_records import TEXTS_TOGETHER, _encoder


@dataclass(frozen=True)
class Packing:
    """``size`` ids a sequence; pieces a group on average; rounds at most, the first included."""

    size: int = 1024
    group_pieces: int = 8000
    rounds: int = 4


_PIECE = fields(
    ("doc_id", T.LongType()),
    ("piece", T.IntegerType()),
    ("start", T.LongType()),
    ("length", T.LongType()),
    ("ids_crc32", T.LongType()),
)


def cuts(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: whole ones last, what is left over first."""
    first = n % size
    return ([(0, first)] if first else []) + [(at, size) for at in range(first, n, size)]


def token_pieces(documents: DataFrame, tokenizer: str, end_id: int, size: int) -> DataFrame:
    """One row per piece; every document has at least the end id. A null text is empty."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        end = encoder.pack([end_id])
        for batch in batches:
            doc_ids, at = batch.column(0).to_pylist(), 0
            rows: list[tuple] = []
            for some in portions(batch.column(1).to_pylist(), TEXTS_TOGETHER):
                for packed in encoder.encode_all(some):
                    ids = np.frombuffer(packed + end, f"<u{encoder.width}").astype("<u4")
                    rows += [
                        (doc_ids[at], n, start, length, zlib.crc32(ids[start : start + length].data))
                        for n, (start, length) in enumerate(cuts(len(ids), size))
                    ]
                    at += 1
            columns = zip(*rows) if rows else [()] * len(_PIECE)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], _PIECE.names)

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(encode, _PIECE)


def best_fit(lengths: list[int], size: int) -> list[list[int]]:
    """Bins of piece numbers: longest first, each into the fullest bin that has room for it."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(size + 1)]
    rooms = 0  # bit r: some bin has room r
    for piece in sorted(range(len(lengths)), key=lambda p: -lengths[p]):
        need = lengths[piece]
        fitting = rooms >> need
        if fitting:
            room = need + (fitting & -fitting).bit_length() - 1
            bin_ = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
            bins[bin_].append(piece)
        else:
            room, bin_ = size, len(bins)
            bins.append([piece])
        left = room - need
        if left:
            by_room[left].append(bin_)
            rooms |= 1 << left
    return bins


class Underfull:
    """Bins with room left, and which lengths, and sums of two, can be had from which of them."""

    def __init__(self, lengths: list[int], bins: list[list[int]], size: int):
        self.lengths, self.size = lengths, size
        self.bins = {n: list(b) for n, b in enumerate(bins)}
        self.fill = {n: sum(lengths[p] for p in b) for n, b in self.bins.items()}
        # By number of pieces less one: bins by length or sum, the emptiest of those, and which there are.
        self.index: list[dict[int, set[int]]] = [defaultdict(set), defaultdict(set)]
        self.emptiest: list[dict[int, int]] = [{}, {}]
        self.present = [0, 0]
        for n in self.bins:
            self._enter(n)

    def _sums(self, n: int) -> tuple[list[int], list[int]]:
        held = Counter(self.lengths[p] for p in self.bins[n])
        ones = sorted(held)
        twos = {a + b for i, a in enumerate(ones) for b in ones[i + 1 :]} | {2 * a for a in ones if held[a] > 1}
        return ones, sorted(twos)

    def _enter(self, n: int) -> None:
        for kind, sums in enumerate(self._sums(n)):
            for s in sums:
                self.index[kind][s].add(n)
                self.emptiest[kind].pop(s, None)
                self.present[kind] |= 1 << s

    def _leave(self, n: int) -> None:
        for kind, sums in enumerate(self._sums(n)):
            for s in sums:
                self.index[kind][s].discard(n)
                self.emptiest[kind].pop(s, None)
                if not self.index[kind][s]:
                    self.present[kind] ^= 1 << s

    def _pieces(self, n: int, total: int, count: int) -> list[int]:
        """Pieces of a bin that have this length, or, two of them, this sum."""
        if count == 0:
            return []
        by_length: dict[int, list[int]] = defaultdict(list)
        for p in self.bins[n]:
            by_length[self.lengths[p]].append(p)
        if count == 1:
            return by_length[total][:1]
        for a in sorted(by_length):
            b = total - a
            if b in by_length and (a != b or len(by_length[a]) > 1):
                return [by_length[a][0], by_length[b][-1]]
        raise KeyError(total)

    def _donor(self, kind: int, total: int, target: int, gain: int) -> int | None:
        """The emptiest other bin that gives this length, if the exchange raises the sum of squares."""
        best = self.emptiest[kind].get(total)
        if best is None:
            best = min(self.index[kind][total], key=lambda n: (self.fill[n], n))
            self.emptiest[kind][total] = best
        if best == target:
            others = self.index[kind][total] - {target}
            if not others:
                return None
            best = min(others, key=lambda n: (self.fill[n], n))
        return best if self.fill[target] + gain > self.fill[best] else None

    def improve(self, target: int) -> bool:
        """The exchange that fills the bin most; False where none raises the sum of squared fills.

        What comes in is one piece or two of another bin, what goes out there nothing, one or two:
        a move, one for one, two for one, or one for two.
        """
        room = self.size - self.fill[target]
        ones, twos = self._sums(target)
        leaving = [(0, 0)] + [(s, 1) for s in ones] + [(s, 2) for s in twos]
        best = None
        for out, n_out in leaving:
            for n_in in (1, 2):
                if n_in == 2 and n_out != 1:
                    continue
                fitting = self.present[n_in - 1] >> (out + 1) & (1 << room) - 1
                if best:  # only what fills more
                    fitting = fitting >> best[0] << best[0]
                while fitting:
                    gain = fitting.bit_length()
                    donor = self._donor(n_in - 1, out + gain, target, gain)
                    if donor is not None:
                        best = gain, donor, n_in, n_out, out
                        break
                    fitting ^= 1 << gain - 1
            if best and best[0] == room:
                break
        if best:
            self._exchange(target, *best)
        return best is not None

    def _exchange(self, target: int, gain: int, donor: int, n_in: int, n_out: int, out: int) -> None:
        for n in (target, donor):
            self._leave(n)
        come, go = self._pieces(donor, out + gain, n_in), self._pieces(target, out, n_out)
        self.bins[target] = [p for p in self.bins[target] if p not in go] + come
        self.bins[donor] = [p for p in self.bins[donor] if p not in come] + go
        self.fill[target] += gain
        self.fill[donor] -= gain
        for n in (target, donor):
            if self.fill[n] == 0:
                del self.bins[n], self.fill[n]
            elif self.fill[n] < self.size:
                self._enter(n)

    def search(self, passes: int = 16) -> list[list[int]]:
        """Exchanges, the fullest bin first, until none helps or the pieces couldn't do with fewer bins."""
        for _ in range(passes):
            better = False
            open_ = {n: f for n, f in self.fill.items() if f < self.size}
            for target in sorted(open_, key=lambda n: (-open_[n], n)):
                while target in self.fill and self.fill[target] < self.size and self.improve(target):
                    better = True
            open_ = [f for f in self.fill.values() if f < self.size]
            if not better or len(open_) <= -(-sum(open_) // self.size):
                break
        return list(self.bins.values())


def pack(lengths: list[int], size: int) -> list[list[int]]:
    """Few bins of piece numbers, none over ``size``."""
    bins = best_fit(lengths, size)
    full = [b for b in bins if sum(lengths[p] for p in b) == size]
    rest = [b for b in bins if sum(lengths[p] for p in b) < size]
    return full + Underfull(lengths, rest, size).search()


def _packed(pieces: DataFrame, groups: int, salt: int, size: int) -> DataFrame:
    """(number, length, sequence, offset, fill): each group packed by one task."""
    layout = pa.schema([(c, pa.int64()) for c in ("number", "length", "sequence", "offset", "fill")])

    def one(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("number").to_numpy())
        numbers = table.column("number").to_numpy()[order].tolist()
        lengths = table.column("length").to_numpy()[order].tolist()
        rows = []
        for bin_ in pack(lengths, size):
            members, at = sorted(bin_), 0
            fill = sum(lengths[p] for p in members)
            for p in members:
                rows.append((numbers[p], lengths[p], numbers[members[0]], at, fill))
                at += lengths[p]
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=layout)

    dealt = pieces.select("number", "length", F.pmod(F.xxhash64("number", F.lit(salt)), F.lit(groups)).alias("dealt"))
    return dealt.groupBy("dealt").applyInArrow(
        lambda table: one(table.drop_columns("dealt")), "number long, length long, sequence long, offset long, fill long"
    )


def pack_pieces(pieces: DataFrame, packing: Packing) -> DataFrame:
    """(number, sequence, offset) of pieces shorter than a sequence, with columns number and length.

    A sequence has the smallest number of its pieces.
    """
    result = None
    bins = None
    for round_ in range(packing.rounds):
        n = pieces.count()
        groups = max(1, -(-n // packing.group_pieces))
        packed = stored(_packed(pieces, groups, round_, packing.size), f"packed-{round_}")
        last = groups == 1 or round_ == packing.rounds - 1
        rest = packed.where(F.col("fill") < packing.size)
        if not last:
            now = rest.where(F.col("offset") == 0).agg(F.count(F.lit(1)).alias("n"), F.sum("fill").alias("s")).first()
            last = now.n <= -(-(now.s or 0) // packing.size) or (bins is not None and now.n >= bins)
            bins = now.n
        done = packed if last else packed.where(F.col("fill") == packing.size)
        result = done if result is None else result.unionByName(done)
        if last:
            break
        pieces = rest.select("number", "length")
    return result.select("number", "sequence", "offset")


def pack_documents(documents: DataFrame, tokenizer: str, end_id: int, packing: Packing | None = None) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32, sequence_id, offset), one per piece.

    A null text is empty: its one piece is the end id. Rows with equal or null ids are packed each
    for itself. An empty table gives no rows. Columns other than doc_id and text are not read.
    """
    packing = packing or Packing()
    cut = token_pieces(documents, tokenizer, end_id, packing.size)
    pieces = stored(cut.withColumn("number", F.monotonically_increasing_id()), "pieces")
    short = pieces.where(F.col("length") < packing.size)
    places = pack_pieces(short.select("number", "length"), packing)
    whole = pieces.where(F.col("length") == packing.size)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    return whole.select(
        *columns, F.col("number").alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    ).unionByName(short.join(places, "number").select(*columns, F.col("sequence").alias("sequence_id"), "offset"))

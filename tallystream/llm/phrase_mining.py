"""Frequent phrases by dynamic itemset counting, and the collocations among them.

The documents are dealt to shards, which are scanned in turn, round and round. Single words are
counted from the first shard on. A longer phrase is counted from the shard after the one with
which both its subphrases, without its last and without its first word, have reached the
threshold, and until the scan has come back to where it began: one full cycle, so that its count
is complete. Lengths are thus counted side by side, and the scan ends when the last
cycle does.

Counters are kept by key, a hash of language and words of 40 bits or more. A scan hands on its counts
in sorted blocks by ranges of keys; where those of a range meet they are added to the counts of the
scans of the same cycle, which are stored, so neither the driver nor a task holds all counters. A
count is never less than that of any phrase of its key, so no frequent phrase is missed.

What has become frequent is broadcast: two tables of bytes, in which a phrase is found by two slots of
its key. Frequent phrases only fill slots, so an infrequent one gets through only if it shares both
with others that are frequent, or its key. One last scan therefore counts the phrases of full slots by
their very words, exactly. The tables bound what is broadcast and what a task holds, however large the
corpus is; smaller tables cost work in the scans, never a result.

Texts are split into words once and written down as portions: the portion's distinct words, their
hashes, and the text as numbers of those words. The scans read the numbers only.

Texts are lower-cased (A to Z) and split into pieces and words by byte. A null text has no words, a
null language is ``und``. Repeated rows count as often as they are there. Scores are exact in
decimals of 38 digits. Columns other than text and lang are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tallystream.llm.common import small_batches, stored

#: Ends of pieces, and a byte that no UTF-8 text holds in their place.
_ENDS, _END = b".,;:!?\n\x0b\x0c\r", b"\xff"
_BYTES = bytes(
    _END[0] if c in _ENDS else c + 32 if 65 <= c <= 90 else c for c in range(256)
)
#: A slot that hasn't reached the threshold.
NEVER = 255
#: A phrase's slots are found by so many bits of its hash, and counts are by these or more.
KEY_BITS = 40
#: A task's phrases are sorted and handed on when there are so many.
HELD = 1 << 21
_MIX, _MIX_2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


@dataclass(frozen=True)
class Counting:
    """``threshold`` occurrences make a phrase frequent; phrases have up to ``longest`` words.

    ``shards`` are scanned in turn; each of two tables has 2 ** ``slot_bits`` slots, and up to four times
    as many where a corpus may have more frequent phrases than half of these. Portions have about
    ``portion_bytes`` of text; a task counts up to ``kept_phrases`` phrases before it hands them on.
    """

    threshold: int = 100
    longest: int = 5
    shards: int = 4
    slot_bits: int = 23
    portion_bytes: int = 2 << 20
    kept_phrases: int = 500_000

    def __post_init__(self):
        # Steps are kept in a byte.
        if not 0 < self.shards < 20 or self.longest < 2 or self.threshold < 1 or self.slot_bits < 1:
            raise ValueError("too many shards, or a limit too small")

    def fitted(self, words: int) -> Counting:
        """With larger tables, if a corpus of so many words may need them.

        Of one length no more phrases are frequent than there are thresholds in its words.
        """
        more = (words // self.threshold >> (self.slot_bits - 1)).bit_length()
        return replace(self, slot_bits=self.slot_bits + min(more, 2)) if self.slot_bits >= 23 else self


class _Codes(dict):
    """Number of each word in order of appearance; 0 is the end mark."""

    def __init__(self):
        super().__init__({_END: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self)
        return code


def words_of(texts: list[bytes]) -> list[bytes]:
    """Words of all texts in order; an end mark between pieces and texts."""
    joined = _END.join(texts).translate(_BYTES)
    return joined.replace(_END, b" \xff ").split()


def _gathered(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[str, list[bytes]]]:
    """Texts of one language, about ``size`` bytes together; of all, twice that are held at most."""
    held: dict[str, tuple[list[bytes], int]] = {}
    total = 0
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        for lang, text in zip(langs, texts):
            some, n = held.get(lang, ([], 0))
            some.append(text)
            held[lang] = some, n + len(text)
            total += len(text)
            if n + len(text) >= size or total >= 2 * size:
                full = max(held, key=lambda k: held[k][1])
                some, n = held.pop(full)
                total -= n
                yield full, some
    for lang, (some, _) in held.items():
        yield lang, some


_PORTION = "lang string, words binary, hashes binary, width int, codes binary, size long, shard int"


def portions_of(documents: DataFrame, counting: Counting) -> DataFrame:
    """Stored portions of the texts (columns lang and text, not null), dealt to shards in turn."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        for lang, texts in _gathered(batches, counting.portion_bytes):
            words, numbers = words_of(texts), _Codes()
            codes = np.fromiter(map(numbers.__getitem__, words), np.uint32, len(words))
            distinct = list(numbers)[1:]
            width = 2 if len(distinct) < 1 << 16 else 4
            hashes = np.array([xxhash.xxh64_intdigest(w) for w in distinct], np.uint64)
            shard += 1
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([lang], pa.string()),
                    "words": pa.array([_END.join(distinct)], pa.binary()),
                    "hashes": pa.array([hashes.tobytes()], pa.binary()),
                    "width": pa.array([width], pa.int32()),
                    "codes": pa.array([codes.astype(f"<u{width}").tobytes()], pa.binary()),
                    "size": pa.array([len(codes)], pa.int64()),
                    "shard": pa.array([shard % counting.shards], pa.int32()),
                }
            )

    return stored(documents.select("lang", "text").mapInArrow(encode, _PORTION), "phrase-portions", "shard")


class Slots:
    """Keys and slots of the phrases of a portion, for one length after the other."""

    def __init__(self, lang: str, hashes: np.ndarray, codes: np.ndarray, counting: Counting):
        self.counting = counting
        seed = np.uint64(xxhash.xxh64_intdigest(lang.encode()))
        of_words = np.concatenate(([np.uint64(0)], hashes))
        self._words = of_words[codes]
        self._inside = codes != 0
        self._codes, self._distinct = codes, (of_words ^ seed) * _MIX
        self._so_far: np.ndarray | None = None
        #: Where a phrase of the present length begins.
        self.starts = np.flatnonzero(self._inside)
        self.length = 1
        #: When both parts of each phrase had reached the threshold; words have none.
        self.later = np.zeros(len(self.starts), np.uint8)
        self._hashes: np.ndarray | None = None

    def _mixed(self, so_far: np.ndarray) -> np.ndarray:
        h = (so_far ^ (so_far >> np.uint64(29))) * _MIX
        # The longest phrases have keys and slots of their own: nothing grows from them.
        flag = np.uint64(1 << 64 - KEY_BITS)
        return h | flag if self.length == self.counting.longest else h & ~flag

    @property
    def hashes(self) -> np.ndarray:
        """Each phrase's hash; its first bits are its key."""
        if self._hashes is None:
            self._hashes = self._mixed(self._distinct)[self._codes[self.starts]] if self.length == 1 else self._mixed(self._so_far)
        return self._hashes

    def reached(self, table: np.ndarray) -> np.ndarray:
        """When each phrase's slots had both reached the threshold, but never before its parts had.

        Others may fill the slots of a phrase before it is counted. What grows from it isn't met before
        its parts have reached the threshold, so a cycle that began with the slots would lack scans.
        """
        hashes = self._mixed(self._distinct) if self.length == 1 else self.hashes
        first, second = slots_of(hashes >> np.uint64(64 - KEY_BITS), self.counting.slot_bits)
        when = np.maximum(table[first], table[second])
        return when[self._codes[self.starts]] if self.length == 1 else np.maximum(when, self.later)

    def grow(self, reached: np.ndarray) -> np.ndarray | None:
        """On to phrases of one word more.

        ``reached`` has, per phrase of this length, when it reached the threshold. Stays with
        phrases both of whose parts have, and returns when the later one did.
        """
        size = len(self._words)
        n, self.length = self.length, self.length + 1
        when = np.full(size + 1, NEVER, np.uint8)
        when[self.starts] = reached
        # Of the phrases that have, those whose next one has too; it lies within the piece.
        own = np.flatnonzero(np.maximum(reached, when[self.starts + 1]) != NEVER)
        starts = self.starts[own]
        if not len(starts):
            return None
        turned = self._distinct[self._codes[starts]] if n == 1 else self._so_far[own]
        self._so_far = ((turned << np.uint64(27) | turned >> np.uint64(37)) + self._words[starts + n]) * _MIX
        self.starts, self.later, self._hashes = starts, np.maximum(reached[own], when[starts + 1]), None
        return self.later


def slots_of(keys: np.ndarray, slot_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The slots of keys of ``KEY_BITS``, of the first table and of the second, which lies behind it."""
    last, bits = keys & np.uint64(1), np.uint64(64 - slot_bits + 1)
    first, second = (((keys * mix) >> bits << np.uint64(1)) | last for mix in (_MIX, _MIX_2))
    return first.astype(np.int64), second.astype(np.int64) + (1 << slot_bits)


def _opened(batches: Iterator[pa.RecordBatch], counting: Counting) -> Iterator[tuple[dict, Slots]]:
    for batch in batches:
        for n in range(batch.num_rows):
            row = {c: batch.column(c)[n].as_py() for c in batch.schema.names}
            row["codes"] = np.frombuffer(row["codes"], f"<u{row['width']}")
            yield row, Slots(row["lang"], np.frombuffer(row["hashes"], "<u8"), row["codes"], counting)


class Counts:
    """How counts travel: blocks of one range of keys, in order, by the rest of the key."""

    def __init__(self, words: int, threshold: int):
        self.range_bits = min(12, max(KEY_BITS - 32, words.bit_length() - 22))
        self.most = min(threshold, (1 << 31) - 1)
        self._kind = np.dtype(np.min_scalar_type(self.most))

    def blocks(self, hashes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Range and counted keys of each range of these phrases."""
        keys = np.sort(hashes >> np.uint64(32 - self.range_bits))
        ends = np.flatnonzero(np.concatenate((keys[1:] != keys[:-1], [True])))
        counted = keys[ends] << np.uint64(32) | np.diff(ends, prepend=-1).astype(np.uint64)
        ranges = (keys[ends] >> np.uint64(32)).astype(np.int64)
        bounds = np.flatnonzero(np.concatenate(([True], ranges[1:] != ranges[:-1], [True])))
        for a, b in zip(bounds, bounds[1:]):
            yield int(ranges[a]), counted[a:b]

    def packed(self, counted: np.ndarray) -> bytes:
        """Differences of keys by their bytes' places, of which the higher ones are mostly 0, and counts."""
        keys = (counted >> np.uint64(32)).astype("<u4")
        times = np.minimum(counted & _COUNT, self.most).astype(self._kind.newbyteorder("<"))  # more is as good
        planes = np.diff(keys, prepend=np.uint32(0)).view(np.uint8).reshape(-1, 4).T.tobytes()
        data = planes + times.tobytes()
        return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)

    def unpacked(self, data: bytes) -> np.ndarray:
        size = int.from_bytes(data[:8], "little")
        plain = pa.decompress(data[8:], size, "zstd", asbytes=True)
        n = size // (4 + self._kind.itemsize)
        planes = np.frombuffer(plain, np.uint8, 4 * n).reshape(4, n)
        keys = np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.uint32)
        return keys.astype(np.uint64) << np.uint64(32) | np.frombuffer(plain, self._kind.newbyteorder("<"), n, 4 * n)

    def key(self, number: int, rest: np.ndarray) -> np.ndarray:
        """Keys of ``KEY_BITS`` of the keys of a range."""
        return (np.uint64(number << 32) | rest.astype(np.uint64)) >> np.uint64(self.range_bits + 32 - KEY_BITS)


#: Counted keys are numbers of 64 bits: the rest of a key, a mark in the middle, and a count.
_COUNT, _NOW = np.uint64((1 << 31) - 1), np.uint64(1 << 31)


def _added(parts: list[np.ndarray], most: int) -> tuple[np.ndarray, np.ndarray]:
    """Counted keys, each once and in order, and where it was marked; no count is beyond ``most``."""
    both = np.sort(np.concatenate(parts))
    keys = both >> np.uint64(32)
    begins = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    times = np.minimum(np.add.reduceat(both & _COUNT, begins), np.uint64(most))
    ends = np.append(begins[1:], len(both)) - 1  # marked ones come last
    return keys[begins] << np.uint64(32) | times, both[ends] & _NOW != 0


@lru_cache(maxsize=1)
def _table(reached: Broadcast) -> np.ndarray:
    """The table that was sent, opened once per worker."""
    return np.frombuffer(zlib.decompress(reached.value), np.uint8)


_COUNTS, _ADDED = "range int, step int, counts binary", "range int, step int, counts binary, new binary"


def _scan(shard: DataFrame, before: list[DataFrame], step: int, reached: Broadcast, counting: Counting, counts: Counts) -> DataFrame:
    """One scan's counts by range, and ``new``: the keys that reach the threshold with it.

    ``before`` are the counts of the scans that may lie in one cycle with this one.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, held = _table(reached), []

        def handed_on() -> pa.RecordBatch:
            some = list(counts.blocks(np.concatenate(held))) if held else []
            held.clear()
            return pa.RecordBatch.from_pydict(
                {
                    "range": pa.array([n for n, _ in some], pa.int32()),
                    "step": pa.array([step] * len(some), pa.int32()),
                    "counts": pa.array([counts.packed(c) for _, c in some], pa.binary()),
                }
            )

        for _, phrases in _opened(batches, counting):
            since = np.zeros(len(phrases.starts), np.int16)
            while True:
                when = phrases.reached(table)
                # Counted from the scan after ``since`` on, for one cycle; words from the first scan on. What has
                # reached the threshold needs no more counts.
                active = (since <= step) & (step < since + counting.shards) & (when == NEVER)
                if active.any():
                    held.append(phrases.hashes[active])
                if phrases.length == counting.longest:
                    break
                later = phrases.grow(when)
                if later is None:
                    break
                since = later.astype(np.int16) + 1
            if sum(map(len, held)) >= HELD:
                yield handed_on()
        yield handed_on()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[list[bytes], list[bytes]]] = {}
        for batch in batches:
            for n, of, data in zip(*(c.to_pylist() for c in batch.columns)):
                found.setdefault(n, ([], []))[of == step].append(data)
        for n, (old, now) in found.items():
            if not now:
                continue
            own, _ = _added([counts.unpacked(data) for data in now], counts.most)
            both, marked = _added([own | _NOW, *map(counts.unpacked, old)], counts.most)
            full = both[marked & (both & _COUNT >= counting.threshold)] >> np.uint64(32)
            own = own[~np.isin(own >> np.uint64(32), full, assume_unique=True)]
            yield pa.RecordBatch.from_pydict(
                {
                    "range": pa.array([n], pa.int32()),
                    "step": pa.array([step], pa.int32()),
                    "counts": pa.array([counts.packed(own)], pa.binary()),
                    "new": pa.array([counts.packed(full << np.uint64(32)) if len(full) else None], pa.binary()),
                }
            )

    scanned = shard.select("lang", "hashes", "width", "codes").mapInArrow(count, _COUNTS)
    for older in before:
        scanned = scanned.union(older.select("range", "step", "counts"))
    return stored(scanned.repartition("range").mapInArrow(add, _ADDED), "phrase-counts")


@dataclass
class Cycle:
    """What the scans have found: when each slot reached the threshold, and how many scans it took."""

    reached: np.ndarray
    steps: int


def count_cyclically(shards: list[DataFrame], counting: Counting) -> Cycle:
    """Dynamic itemset counting, shard after shard, until every cycle is complete."""
    spark = shards[0].sparkSession
    counts = Counts(words_in(reduce(DataFrame.union, shards)), counting.threshold)
    reached = np.full(2 << counting.slot_bits, NEVER, np.uint8)
    scans: list[DataFrame] = []
    step, last = 0, -1  # the last scan after which something that others grow from was new
    while step < counting.shards or last > step - 1 - counting.shards:
        if step == NEVER:
            raise RuntimeError("more scans than a byte holds")
        sent = spark.sparkContext.broadcast(zlib.compress(reached.tobytes(), 1))
        before = scans[max(0, step - counting.shards + 1) :]
        scans.append(_scan(shards[step % counting.shards], before, step, sent, counting, counts))
        for row in scans[-1].where("new is not null").select("range", "new").collect():
            keys = counts.key(row.range, counts.unpacked(bytes(row.new)) >> np.uint64(32))
            slots = np.concatenate(slots_of(keys, counting.slot_bits))
            slots = slots[reached[slots] == NEVER]
            reached[slots] = step
            if not (slots & 1).all():  # even slots: all but the longest phrases
                last = step
        sent.destroy(blocking=True)
        step += 1
    return Cycle(reached, step)


def words_in(portions: DataFrame) -> int:
    return portions.agg(F.sum("size")).first()[0] or 0


_BLOCK, _COUNTED = "lang string, range int, phrases binary, counts binary", "lang string, phrase string, size int, n long"


def _blocks(counts: dict[str, dict[bytes, int]], ranges: int) -> Iterator[pa.RecordBatch]:
    """Counts as blocks: the phrases of a language whose hashes fall into one range, in order, with their counts."""
    for lang, found in counts.items():
        some: dict[int, list[bytes]] = {}
        for phrase in sorted(found):
            some.setdefault(zlib.crc32(phrase) % ranges, []).append(phrase)
        yield pa.RecordBatch.from_pydict(
            {
                "lang": pa.array([lang] * len(some), pa.string()),
                "range": pa.array(list(some), pa.int32()),
                "phrases": pa.array([zlib.compress(_END.join(p), 1) for p in some.values()], pa.binary()),
                "counts": pa.array([np.array([found[x] for x in p], "<i8").tobytes() for p in some.values()], pa.binary()),
            }
        )


def _rows(counts: dict[str, dict[bytes, int]]) -> Iterator[pa.RecordBatch]:
    for lang, found in counts.items():
        yield pa.RecordBatch.from_pydict(
            {
                "lang": pa.array([lang] * len(found), pa.string()),
                "phrase": pa.array(list(found), pa.string()),
                "size": pa.array([p.count(b" ") + 1 if p else 0 for p in found], pa.int32()),
                "n": pa.array(list(found.values()), pa.int64()),
            }
        )


def _exact(portions: DataFrame, reached: Broadcast, counting: Counting) -> DataFrame:
    """(lang, phrase, size, n): occurrences of the phrases of full slots; size 0: of all words.

    Tasks hand on their counts in blocks by ranges of hashes; those of a range are added up where they
    meet, each phrase once, before they become rows. A task that holds too many hands on what it has.
    """
    ranges = max(64, int(portions.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(reached)
        counts: dict[str, Counter] = {}
        for row, phrases in _opened(batches, counting):
            own = counts.setdefault(row["lang"], Counter())
            codes = row["codes"].astype(np.int64)
            words = [_END, *row["words"].split(_END)]
            own[b""] += len(phrases.starts)
            # A phrase's number: the words' own first, then that of all but its last word, and that word.
            numbers = codes.copy()
            while len(phrases.starts):
                when, n = phrases.reached(table), phrases.length
                full = phrases.starts[when != NEVER]
                found, first, times = np.unique(numbers[full], return_index=True, return_counts=True)
                for i, k in zip(full[first].tolist(), times.tolist()):
                    own[b" ".join([words[c] for c in codes[i : i + n].tolist()])] += k
                if n == counting.longest or phrases.grow(when) is None:
                    break
                longer = np.searchsorted(found, numbers[phrases.starts]) * len(words) + codes[phrases.starts + n]
                numbers[phrases.starts] = longer
            if sum(map(len, counts.values())) > counting.kept_phrases:
                yield from _blocks(counts, ranges)
                counts.clear()
        yield from _blocks(counts, ranges)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, Counter] = {}
        for batch in batches:
            for lang, phrases, counts in zip(*(batch.column(c).to_pylist() for c in ("lang", "phrases", "counts"))):
                own = sums.setdefault(lang, Counter())
                for phrase, n in zip(zlib.decompress(phrases).split(_END), np.frombuffer(counts, "<i8").tolist()):
                    own[phrase] += n
                if sum(map(len, sums.values())) > counting.kept_phrases:
                    yield from _rows(sums)
                    sums.clear()
        yield from _rows(sums)

    rows = portions.select("lang", "words", "hashes", "width", "codes")
    counted = rows.mapInArrow(count, _BLOCK).repartition("range").mapInArrow(add, _COUNTED)
    return counted.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n"))


def frequent_phrases(documents: DataFrame, counting: Counting | None = None) -> DataFrame:
    """Stored rows (lang, phrase, size, n): every phrase of up to ``longest`` words that is frequent.

    ``size`` is its number of words. A row of size 0 and empty phrase has the words of a language.
    """
    counting = counting or Counting()
    spark = documents.sparkSession
    small_batches(spark)
    rows = documents.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    portions = portions_of(rows, counting)
    counting = counting.fitted(words_in(portions))
    shards = [portions.where(F.col("shard") == n) for n in range(counting.shards)]
    cycle = count_cyclically(shards, counting)
    found = _exact(portions, spark.sparkContext.broadcast(zlib.compress(cycle.reached.tobytes(), 1)), counting)
    kept = (F.col("n") >= counting.threshold) | (F.col("size") == 0)
    return stored(found.where(kept), "phrases")


def collocations(documents: DataFrame, first: int = 2000, counting: Counting | None = None) -> DataFrame:
    """Rows (lang, rank, phrase, a, l, r, n, score): the ``first`` best scored phrases per language.

    Phrases have two words or more. Cut after k words, a phrase of count a has a score of
    floor(1000 a n / (l r)), where l and r count its parts and n all words of the language; the
    lowest cut counts, of equal ones the one with the smallest k. A phrase that lies in a longer
    frequent one of the same count is left out. Equal scores go by a, then by the phrase's bytes.
    """
    phrases = frequent_phrases(documents, counting)
    total = phrases.where("size = 0").select("lang", F.col("n").alias("total"))
    parts = phrases.where("size > 0").select("lang", "phrase", F.col("n").alias("times"))
    long = phrases.where("size > 1").select("lang", "phrase", "size", F.col("n").alias("a"))
    words = F.split("phrase", " ")

    cuts = long.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice(words, F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice(words, F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("right"),
    )
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(parts.select("lang", F.col("phrase").alias(side), F.col("times").alias(name)), ["lang", side])
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    cuts = cuts.join(total, "lang").withColumns({"_over": wide("a") * wide("total") * 1000, "_under": wide("l") * wide("r")})
    cuts = cuts.withColumn("score", F.expr("_over div _under"))
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r", "total")).alias("cut"))

    spans = F.expr(
        "flatten(transform(sequence(2, size - 1), k -> transform(sequence(1, size - k + 1), "
        "i -> array_join(slice(split(phrase, ' '), i, k), ' '))))"
    )
    inner = long.where("size > 2").select("lang", "a", F.explode(F.array_distinct(spans)).alias("phrase"))
    covers = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    alone = scored.join(covers, ["lang", "phrase"], "left").where("longer is null or longer < a")

    rows = alone.select(
        "lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.total").alias("n"),
        F.col("cut.score").alias("score"),
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # A language's best are the best of its parts' best, so no task ranks all its phrases.
    rows = rows.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    for by in (["lang", "_part"], ["lang"]):
        rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= first)
    return rows.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")

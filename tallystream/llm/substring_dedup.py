"""Removal of passages that an earlier document has, by super-k-mers.

A window is ``SPAN`` consecutive words. The *minimiser* of a window is the smallest hash among its
word pairs; neighbouring windows mostly share it, so a run of them (a super-k-mer) travels as one
packed string to the bucket of that minimiser. A task packs the runs of one bucket into blocks,
each distinct string once however many documents have it. In a bucket the windows of all strings
are sorted by hash, equal neighbours are compared byte by byte, and each group's smallest document
id decides: a window is a repeat wherever it stands in a document with a larger id. The spans of
repeats go back to their documents.

Sizes come from the data: a first pass counts windows per bucket. Where the windows of one bucket
are too many (a frequent minimiser), they are dealt out again, one by one, by their own hash, so
that only equal windows must meet, and those are combined before they travel.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F, types as T

from tallystream.llm.common import stored, text_or_empty
from tallystream.llm.wordhash import PORTION_BYTES, Words, pieces
from tallystream.operators.joins import lookup_join

SPAN = 13
#: Bytes of text a bucket is meant for, windows beyond which it is dealt out again (about four
#: times that), and packed strings that a task gathers before writing blocks.
BUCKET_BYTES, BUCKET_WINDOWS = 4 << 20, 4 << 20
GATHER_BYTES = 24 << 20
NO_ID = 2**63 - 1

BLOCKS = T.StructType([T.StructField("bucket", T.LongType()), T.StructField("block", T.BinaryType())])
COUNTS = T.StructType([T.StructField("bucket", T.LongType()), T.StructField("windows", T.LongType())])
REPEATS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("key", T.LongType()),
        T.StructField("more", T.LongType()),
        T.StructField("first", T.LongType()),
        T.StructField("windows", T.LongType()),
    ]
)
KEPT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("kept_text", T.StringType()),
    ]
)


def _portions(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[tuple[Words, np.ndarray, np.ndarray, np.ndarray]]:
    """Words of about PORTION_BYTES of text, with id, both parts of the key and words before for each text."""
    texts, ids, keys, befores, held = [], [], [], [], 0
    for batch in batches:
        for doc, key, more, text in zip(*(batch.column(n) for n in ("id", "key", "more", "text"))):
            for piece, before in pieces(text.as_py().encode(), span):
                if texts and held + len(piece) > PORTION_BYTES:
                    yield Words(texts), np.array(ids), np.array(keys), np.array(befores)
                    texts, ids, keys, befores, held = [], [], [], [], 0
                texts.append(piece)
                ids.append(doc.as_py())
                keys.append((key.as_py(), more.as_py()))
                befores.append(before)
                held += len(piece)
    if texts:
        yield Words(texts), np.array(ids), np.array(keys), np.array(befores)


def _bucket_counts(buckets: int, span: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, int] = {}
        for words, *_ in _portions(batches, span):
            at = words.window_starts(span)
            if len(at):
                found, n = np.unique(words.minimisers(span)[at] % np.uint64(buckets), return_counts=True)
                for bucket, windows in zip(found.tolist(), n.tolist()):
                    counts[bucket] = counts.get(bucket, 0) + windows
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())], COUNTS.names
        )

    return count


class _Gathered:
    """Runs of one bucket: distinct strings and where they stand."""

    __slots__ = ("strings", "index", "ids", "keys", "firsts")

    def __init__(self):
        self.strings: dict[bytes, int] = {}
        self.index, self.ids, self.keys, self.firsts = [], [], [], []

    def block(self, zip_) -> bytes:
        strings = list(self.strings)
        ids, keys = np.array(self.ids, np.int64), np.array(self.keys, np.int64).reshape(-1, 2)
        return zip_.compress(
            b"".join(
                (
                    struct.pack("<II", len(strings), len(ids)),
                    np.array([len(s) for s in strings], "<u4").tobytes(),
                    np.array(self.index, "<u4").tobytes(),
                    np.diff(ids, prepend=0).astype("<i8").view("u1").reshape(-1, 8).T.tobytes(),
                    keys[:, 0].astype("<u4").tobytes(),
                    # Nearly always all zero, so it takes no room.
                    keys[:, 1].astype("<i8").tobytes(),
                    np.array(self.firsts, "<u4").view("u1").reshape(-1, 4).T.tobytes(),
                    *strings,
                )
            )
        )


def _open(block: bytes, unzip) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data = unzip.decompress(block)
    n, m = struct.unpack_from("<II", data)
    at = 8
    sizes = np.frombuffer(data, "<u4", n, at)
    at += 4 * n
    index = np.frombuffer(data, "<u4", m, at)
    at += 4 * m
    ids = np.cumsum(np.ascontiguousarray(np.frombuffer(data, "u1", 8 * m, at).reshape(8, m).T).view("<i8").ravel())
    at += 8 * m
    keys = np.empty((m, 2), np.int64)
    keys[:, 0] = np.frombuffer(data, "<u4", m, at)
    at += 4 * m
    keys[:, 1] = np.frombuffer(data, "<i8", m, at)
    at += 8 * m
    firsts = np.ascontiguousarray(np.frombuffer(data, "u1", 4 * m, at).reshape(4, m).T).view("<u4").ravel()
    at += 4 * m
    ends = (at + np.cumsum(sizes, dtype=np.int64)).tolist()
    return [data[a:b] for a, b in zip([at, *ends], ends)], index, ids, keys, firsts


def _pack(buckets: int, crowded: list[int], extra: int, span: int):
    """Runs of texts as blocks; the windows of crowded buckets go to ``extra`` others by their hash."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zip_ = zstandard.ZstdCompressor(level=3)
        dense = np.array(sorted(crowded), np.uint64)
        gathered: dict[int, _Gathered] = {}
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            names = sorted(gathered)
            for lo in range(0, len(names), 64):
                some = names[lo : lo + 64]
                blocks = [gathered[b].block(zip_) for b in some]
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(blocks, pa.binary())], BLOCKS.names)
            gathered.clear()

        for words, ids, keys, befores in _portions(batches, span):
            at = words.window_starts(span)
            if not len(at):
                continue
            route = words.minimisers(span)[at]
            bucket = route % np.uint64(buckets)
            if len(dense):
                again = np.isin(bucket, dense)
                own = words.window_hashes(span)[at[again]]
                route[again] = own
                bucket[again] = np.uint64(buckets) + own % np.uint64(extra)
            owner = words.owner[at]
            begins = np.concatenate(([True], (route[1:] != route[:-1]) | (owner[1:] != owner[:-1])))
            lead = np.flatnonzero(begins)
            first = at[lead]
            last = at[np.append(lead[1:], len(at)) - 1] + span - 1
            texts = words.slices(first, last)
            # Words of a text before its piece, plus those of the piece before the run.
            head = np.searchsorted(words.owner, owner[lead], side="left")
            place = (befores[owner[lead]] + first - head).tolist()
            rows = zip(bucket[lead].tolist(), texts, ids[owner[lead]].tolist(), keys[owner[lead]].tolist(), place)
            for b, text, doc, key, start in rows:
                some = gathered.get(b)
                if some is None:
                    some = gathered[b] = _Gathered()
                number = some.strings.setdefault(text, len(some.strings))
                some.index.append(number)
                some.ids.append(doc)
                some.keys.append(key)
                some.firsts.append(start)
            held += sum(map(len, texts)) + 200 * len(texts)
            if held > GATHER_BYTES:
                yield from flush()
                held = 0
        yield from flush()

    return pack


def _smallest_ids(strings: list[bytes], least: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """For all windows of all strings in order: the smallest id of a document with that window;
    and windows per string. ``least``: smallest id of a document with each string."""
    hashes, owners, begins, ends = [], [], [], []
    lo = 0
    while lo < len(strings):
        hi, size = lo, 0
        while hi < len(strings) and (hi == lo or size + len(strings[hi]) <= PORTION_BYTES):
            size += len(strings[hi])
            hi += 1
        words = Words(strings[lo:hi])
        at = words.window_starts(span)
        hashes.append(words.window_hashes(span)[at])
        base = np.cumsum([0, *(len(s) + 1 for s in strings[lo : hi - 1])])
        owner = words.owner[at]
        owners.append(owner + lo)
        begins.append(words.starts[at] - base[owner])
        ends.append(words.starts[at + span - 1] + words.sizes[at + span - 1] - base[owner])
        lo = hi
    h, owner, begin, end = map(np.concatenate, (hashes, owners, begins, ends))
    order = np.argsort(h, kind="stable")
    leads = np.flatnonzero(np.concatenate(([True], h[order][1:] != h[order][:-1])))
    group = np.empty(len(h), np.int64)
    group[order] = np.repeat(np.arange(len(leads)), np.diff(np.append(leads, len(h))))
    own = least[owner]
    smallest = np.minimum.reduceat(own[order], leads)[group]
    # Windows of one hash are compared word for word; of unequal ones each gets its own minimum.
    several = np.flatnonzero(np.bincount(group)[group[order]] > 1)
    current, first, mixed = -1, b"", set()
    places = order[several]
    for g, w, a, b in zip(group[places].tolist(), owner[places].tolist(), begin[places].tolist(), end[places].tolist()):
        text = strings[w][a:b]
        if g != current:
            current, first = g, text
        elif text != first:
            mixed.add(g)
    for g in mixed:
        best: dict[bytes, int] = {}
        members = np.flatnonzero(group == g)
        named = [strings[owner[i]][begin[i] : end[i]] for i in members]
        for i, text in zip(members, named):
            best[text] = min(best.get(text, NO_ID), int(own[i]))
        smallest[members] = [best[text] for text in named]
    return smallest, np.bincount(owner, minlength=len(strings))


def _find_repeats(span: int):
    def find(table: pa.Table) -> pa.Table:
        unzip = zstandard.ZstdDecompressor()
        strings: list[bytes] = []
        index, ids, keys, firsts = [], [], [], []
        for block in table.column("block"):
            found = _open(block.as_py(), unzip)
            index.append(found[1].astype(np.int64) + len(strings))
            strings += found[0]
            for held, new in zip((ids, keys, firsts), found[2:]):
                held.append(new)
        index, ids, keys, firsts = map(np.concatenate, (index, ids, keys, firsts))
        least = np.full(len(strings), NO_ID, np.int64)
        np.minimum.at(least, index, ids)
        smallest, windows = _smallest_ids(strings, least, span)
        begin = np.cumsum(windows) - windows
        low, high = np.minimum.reduceat(smallest, begin), np.maximum.reduceat(smallest, begin)
        whole = high[index] < ids
        out = [(ids[whole], keys[whole], firsts[whole], windows[index[whole]])]
        for o in np.flatnonzero(~whole & (low[index] < ids)).tolist():
            s = index[o]
            repeated = smallest[begin[s] : begin[s] + windows[s]] < ids[o]
            edges = np.flatnonzero(np.diff(repeated, prepend=False, append=False))
            n = len(edges) // 2
            starts = firsts[o].astype(np.int64) + edges[::2]
            out.append((np.full(n, ids[o]), np.tile(keys[o], (n, 1)), starts, edges[1::2] - edges[::2]))
        found_ids, found_keys, *rest = (np.concatenate([o[k] for o in out]).astype(np.int64) for k in range(4))
        columns = [found_ids, found_keys[:, 0], found_keys[:, 1], *rest]
        return pa.Table.from_arrays([pa.array(c) for c in columns], REPEATS.names)

    return find


def repeats(rows: DataFrame, span: int = SPAN, bucket_bytes: int = BUCKET_BYTES, bucket_windows: int = BUCKET_WINDOWS) -> DataFrame:
    """Runs of repeated windows in rows of id, key, more, text: id, key, more, first word, windows."""
    spark = rows.sparkSession
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(-(-size // bucket_bytes), int(spark.conf.get("spark.sql.shuffle.partitions")))
    counts = rows.mapInArrow(_bucket_counts(buckets, span), COUNTS).groupBy("bucket").agg(F.sum("windows").alias("n"))
    # At most one in ``size / bucket_windows`` buckets can be crowded, so their list is short.
    crowded = counts.where(F.col("n") > bucket_windows).collect()
    extra = -(-sum(r.n for r in crowded) // max(1, bucket_windows // 4)) if crowded else 1
    blocks = rows.mapInArrow(_pack(buckets, [r.bucket for r in crowded], max(extra, 1), span), BLOCKS)
    return blocks.groupBy("bucket").applyInArrow(_find_repeats(span), REPEATS)


def _strip(span: int):
    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids, texts, firsts, windows = (batch.column(n) for n in ("doc_id", "text", "firsts", "windows"))
            lo = 0
            while lo < len(texts):
                hi, size, out = lo, 0, []
                while hi < len(texts) and size <= PORTION_BYTES:
                    words = texts[hi].as_py().encode().split()
                    n, at, runs = len(words), firsts[hi].as_py(), windows[hi].as_py()
                    if at:
                        gone = np.zeros(n + 1, np.int64)
                        np.add.at(gone, np.array(at), 1)
                        np.subtract.at(gone, np.array(at) + np.array(runs) + span - 1, 1)
                        stays = np.cumsum(gone[:n]) == 0
                        words = [words[i] for i in np.flatnonzero(stays).tolist()]
                    kept = b" ".join(words)
                    out.append((n, n - len(words), kept.decode()))
                    size += len(kept) + 64
                    hi += 1
                columns = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [
                        doc_ids.slice(lo, hi - lo),
                        *(pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.string()))),
                    ],
                    KEPT.names,
                )
                lo = hi

    return strip


def remove_repeats(documents: DataFrame, span: int = SPAN, **sizes: int) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_text (kept words joined by single spaces).

    Words stand between ASCII white space. A word goes when a window over it also begins in a
    document with a smaller doc_id; windows are judged on the input. Null texts have no words,
    texts shorter than a window lose none. A null doc_id is larger than any other. Rows of one
    doc_id don't repeat each other. Only doc_id and text are read. An empty table stays empty.
    """
    text = text_or_empty()
    ids = documents.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.count(F.lit(1)).alias("n"))
    several = stored(ids.where("n > 1 and doc_id is not null").select("doc_id"), "repeated-ids")
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    alone = F.col("doc_id").isNotNull()
    if not several.isEmpty():
        rows = lookup_join(rows, several.withColumn("_several", F.lit(True)), ["doc_id"])
        alone = alone & F.col("_several").isNull()
    # Rows of one id are told apart by 96 bits of their texts; rows alike in those have the same text.
    # Where the id tells the row, most of the bits are zero.
    rows = rows.select(
        "doc_id",
        F.coalesce("doc_id", F.lit(NO_ID)).alias("id"),
        F.crc32("text").alias("key"),
        F.when(alone, F.lit(0).cast("long")).otherwise(F.xxhash64("text")).alias("more"),
        "text",
    )
    key = ["id", "key", "more"]
    found = repeats(rows.select(*key, "text"), span, **sizes)
    spans = found.groupBy(*key).agg(
        F.collect_list(F.struct("first", "windows")).alias("s")
    ).select(*key, F.col("s.first").alias("firsts"), F.col("s.windows").alias("windows"))
    joined = rows.join(spans, key, "left").select("doc_id", "text", "firsts", "windows")
    return joined.mapInArrow(_strip(span), KEPT)

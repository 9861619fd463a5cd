"""Documents alike in their word shingles, by MinHash with Bayesian pruning.

1. Every text becomes its distinct shingles and a signature of MinHash values. Texts of the same
   words are one *class*; only classes are compared, copies are counted.
2. Classes that agree in a band of values may be alike. Bands are chosen so that a pair at the
   threshold agrees in none with a probability of about 5e-6. Agreement ties classes together to
   neighbourhoods: connected components, found without listing pairs.
3. Neighbourhoods are compared in blocks of bounded size, every block with every other. The values
   of two signatures are compared a few at a time; a pair is dropped as soon as, given the
   agreements so far and a flat prior, the probability that its similarity reaches the threshold is
   under the tolerance. What is left is verified on the whole shingle sets.
4. A block returns one row per class, with its links counted and a tie to its group, never pairs.
   The ties' components are the groups of documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tallystream.llm.common import fields, portions, stored, text_or_empty
from tallystream.llm.components import connected_components
from tallystream.llm.wordhash import Words, pieces
from tallystream.operators.joins import lookup_join
from tallystream.session import settle

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 40, 6
VALUES = BANDS * ROWS
TOLERANCE, STEP = 1e-6, 16
#: Classes of a block, and classes of small neighbourhoods that are compared by one call.
BLOCK, TOGETHER = 400, 500
#: Bytes of texts whose shingles are in memory at once, with some 30 bytes for each; a longer text is
#: taken alone.
TEXT_BYTES = 256 << 10
NO_ID = 2**63 - 1

# Word bytes as they are, A-Z lower-cased, everything else a space.
_NORMAL = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)

SIGNED = fields(
    ("doc_id", T.LongType()),
    ("id", T.LongType()),
    ("text_key", T.LongType()),
    ("key", T.BinaryType()),
    ("signature", T.BinaryType()),
)
LINKED = fields(
    ("key", T.BinaryType()),
    ("root", T.BinaryType()),
    ("links", T.LongType()),
)


def normal_words(text: str) -> bytes:
    return b" ".join(text.encode().translate(_NORMAL).split())


def _coefficients() -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(20_240_901)
    a = random.integers(0, 1 << 32, VALUES, dtype=np.uint32) | np.uint32(1)
    return a, random.integers(0, 1 << 32, VALUES, dtype=np.uint32)


_A, _B = _coefficients()


def shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of normal texts, with the number of the text of each, in order.

    A text of fewer words than a shingle has is one shingle; one of no words has none.
    """
    parts, owners = [], []
    for n, text in enumerate(texts):
        for piece, _ in pieces(text, SHINGLE):
            parts.append(piece)
            owners.append(n)
    words = Words(parts)
    at = words.window_starts(SHINGLE)
    hashes, owner = words.window_hashes(SHINGLE)[at], np.array(owners, np.int64)[words.owner[at]]
    short = [n for n, t in enumerate(texts) if t and t.count(b" ") < SHINGLE - 1]
    if short:
        own = [int.from_bytes(blake2b(texts[n], digest_size=8).digest(), "little") for n in short]
        hashes = np.concatenate((hashes, np.array(own, np.uint64)))
        owner = np.concatenate((owner, np.array(short)))
        order = np.argsort(owner, kind="stable")
        hashes, owner = hashes[order], owner[order]
    return hashes, owner


def signatures(hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Low halves of the MinHash values of n texts; zero for texts without shingles."""
    found = np.zeros((n, VALUES), np.uint16)
    if len(hashes):
        lead = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        x = (hashes >> np.uint64(32)).astype(np.uint32)
        columns = np.empty((VALUES, len(lead)), np.uint32)
        mixed = np.empty_like(x)
        for k in range(VALUES):
            np.multiply(x, _A[k], out=mixed)
            mixed += _B[k]
            columns[k] = np.minimum.reduceat(mixed, lead)
        found[owner[lead]] = (columns & np.uint32(0xFFFF)).T
    return found


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text")
        lo = 0
        while lo < len(texts):
            normal, size = [], 0
            while lo + len(normal) < len(texts) and size < TEXT_BYTES:
                normal.append(normal_words(texts[lo + len(normal)].as_py()))
                size += len(normal[-1])
            hashes, owner = shingles(normal)
            rows = signatures(hashes, owner, len(normal))
            keys = [blake2b(t, digest_size=16).digest() if t else None for t in normal]
            signed = [r.tobytes() if t else None for r, t in zip(rows, normal)]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c).slice(lo, len(normal)) for c in ("doc_id", "id", "text_key")),
                    pa.array(keys, pa.binary()),
                    pa.array(signed, pa.binary()),
                ],
                SIGNED.names,
            )
            lo += len(normal)


def least_agreements(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[int]:
    """Agreements among the first n values under which a pair is dropped, for every n.

    With a flat prior the similarity after m agreements of n is Beta(m + 1, n - m + 1); that it
    reaches the threshold has the probability that a binomial of n + 1 trials gives at most m.
    """
    least = [0]
    for n in range(1, VALUES + 1):
        below, m = 0.0, -1
        while below < tolerance:
            m += 1
            below += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        least.append(m)
    return least


@lru_cache(maxsize=1)
def _least() -> list[int]:
    return least_agreements()


def likely_pairs(a: np.ndarray, b: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows (i of a, j of b) that pruning leaves; with ``same`` only i < j."""
    least = _least()
    agree = np.zeros((len(a), len(b)), np.int16)
    for k in range(2 * STEP):
        agree += a[:, k, None] == b[None, :, k]
    alive = agree >= least[2 * STEP]
    if same:
        alive &= np.triu(np.ones(alive.shape, bool), 1)
    i, j = np.nonzero(alive)
    counted = agree[i, j].astype(np.int32)
    for at in range(2 * STEP, VALUES, STEP):
        if not len(i):
            break
        counted += (a[i, at : at + STEP] == b[j, at : at + STEP]).sum(1)
        stay = counted >= least[min(at + STEP, VALUES)]
        i, j, counted = i[stay], j[stay], counted[stay]
    return i, j


def alike(i: np.ndarray, j: np.ndarray, sets_a: list[np.ndarray], sets_b: list[np.ndarray]) -> np.ndarray:
    """Which of the pairs reach the threshold, on their whole shingle sets."""
    sizes_a, sizes_b = np.array([len(s) for s in sets_a]), np.array([len(s) for s in sets_b])
    both = np.zeros(len(i), np.int64)
    if len(i) < 4 * (len(sets_a) + len(sets_b)):
        for n, (p, q) in enumerate(zip(i.tolist(), j.tolist())):
            both[n] = len(np.intersect1d(sets_a[p], sets_b[q], assume_unique=True))
    else:
        # Shared shingles, some thousands at a time, as 0/1 matrices whose product counts them.
        shared = np.intersect1d(np.unique(np.concatenate(sets_a)), np.unique(np.concatenate(sets_b)))
        counted = np.zeros((len(sets_a), len(sets_b)), np.float64)
        for lo in range(0, len(shared), 4096):
            some = shared[lo : lo + 4096]
            matrices = []
            for sets in (sets_a, sets_b):
                m = np.zeros((len(sets), len(some)), np.float32)
                for n, s in enumerate(sets):
                    inside = s[np.searchsorted(s, some[0]) : np.searchsorted(s, some[-1], side="right")]
                    place = np.searchsorted(some, inside)
                    m[n, place[some[place] == inside]] = 1
                matrices.append(m)
            counted += matrices[0] @ matrices[1].T
        both = counted[i, j].astype(np.int64)
    return both >= THRESHOLD * (sizes_a[i] + sizes_b[j] - both) - 1e-9


def _root(parent: np.ndarray, n: int) -> int:
    while parent[n] != n:
        parent[n] = parent[parent[n]]
        n = parent[n]
    return n


def _compare(keys: list[bytes], copies: np.ndarray, blocks: np.ndarray, texts: list[bytes]) -> list[tuple]:
    """Links of each class within one neighbourhood's block, or between two of its blocks."""
    signed, sets = [], []
    for some in portions(texts, TEXT_BYTES):
        hashes, owner = shingles(some)
        signed.append(signatures(hashes, owner, len(some)))
        edges = np.searchsorted(owner, np.arange(len(some) + 1))
        sets += [np.unique(hashes[a:b]) for a, b in zip(edges[:-1], edges[1:])]
    values = np.concatenate(signed)
    one = blocks == blocks.min()
    a = np.flatnonzero(one)
    b = a if one.all() else np.flatnonzero(~one)
    i, j = likely_pairs(values[a], values[b], one.all())
    good = alike(i, j, [sets[n] for n in a], [sets[n] for n in b])
    i, j = a[i[good]], b[j[good]]
    links = np.bincount(i, copies[j], len(keys)) + np.bincount(j, copies[i], len(keys))
    parent = np.arange(len(keys))
    for p, q in zip(i.tolist(), j.tolist()):
        p, q = _root(parent, p), _root(parent, q)
        if p != q:
            parent[max(p, q)] = min(p, q)
    return [(keys[n], keys[_root(parent, n)], int(links[n])) for n in range(len(keys))]


def _compare_blocks(table: pa.Table) -> pa.Table:
    rows = list(zip(*(table.column(c).to_pylist() for c in ("place", "key", "block", "n", "text"))))
    out: list[tuple] = []
    rows.sort(key=lambda r: r[:3])
    lo = 0
    while lo < len(rows):
        hi = lo
        while hi < len(rows) and rows[hi][0] == rows[lo][0]:
            hi += 1
        by_key = {r[1]: r for r in rows[lo:hi]}  # rows alike in id and text come twice
        if len(by_key) > 1:
            keys = sorted(by_key)
            out += _compare(
                keys,
                np.array([by_key[k][3] for k in keys], np.int64),
                np.array([by_key[k][2] for k in keys]),
                [normal_words(by_key[k][4]) for k in keys],
            )
        lo = hi
    columns = list(zip(*out)) if out else [(), (), ()]
    return pa.Table.from_arrays(
        [pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.int64())],
        LINKED.names,
    )


def _band_ties(classes: DataFrame) -> DataFrame:
    """Edges that tie each class to the smallest one in every band it shares."""
    bands = classes.select(
        "key",
        F.posexplode(
            F.transform(
                F.sequence(F.lit(0), F.lit(BANDS - 1)),
                lambda k: F.substring(F.col("signature"), k * F.lit(2 * ROWS) + 1, F.lit(2 * ROWS)),
            )
        ).alias("number", "values"),
    ).select("key", F.xxhash64("number", "values").alias("band"))
    shared = settle(bands.groupBy("band").agg(F.min("key").alias("v"), F.max("key").alias("w")).where("v <> w").select("band", "v"))
    tied = lookup_join(bands, shared, ["band"], "inner")
    return tied.select(F.col("key").alias("u"), "v")


def near_groups(documents: DataFrame) -> DataFrame:
    """One row per document row: doc_id, class_id, n_links, n_copies, stays.

    Words are runs of letters, digits and characters beyond ASCII, A-Z lower-cased; a text of
    fewer words than a shingle is one shingle. ``n_links`` counts the other documents of similarity
    ``THRESHOLD`` or more, ``n_copies`` those with the same words, the row itself included;
    ``class_id`` is the smallest doc_id among all documents that links lead to. ``stays`` holds for
    one document of each such group, the one of smallest doc_id. A document without words (null,
    empty, only signs) is like no other: it has its own doc_id as class and stays. A null doc_id is
    larger than any other. Equal rows, doc_id included, are copies of each other and stay or go
    together. Only doc_id and text are read.
    """
    text = text_or_empty()
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"),
        F.xxhash64(text).alias("text_key"),
        text.alias("text"),
    )
    signed = stored(rows.mapInArrow(_sign, SIGNED), "signatures")
    first = F.struct("id", "text_key")
    classes = settle(
        signed.where("key is not null")
        .groupBy("key")
        .agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("n"), F.max("signature").alias("signature"))
    )
    near = connected_components(_band_ties(classes)).select(F.col("node").alias("key"), F.col("root").alias("place"))
    sizes = near.groupBy("place").agg(F.count(F.lit(1)).alias("size"))
    members = (
        classes.select("key", "first", "n")
        .join(near, "key")
        .join(sizes, "place")
        .withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
        .select(F.col("first.id").alias("id"), F.col("first.text_key").alias("text_key"), "key", "place", "n", "blocks", "block")
    )
    members = settle(members)
    calls = max(1, -(-members.where("blocks = 1").count() // TOGETHER))
    with_text = lookup_join(rows.select("id", "text_key", "text"), members, ["id", "text_key"], "inner")
    low = lambda o: F.least("block", o)
    high = lambda o: F.greatest("block", o)
    meeting = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda o: F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("place"), F.lit(calls))).otherwise(
            F.xxhash64("place", low(o), high(o))
        ),
    )
    # One meeting of two blocks holds rows of one neighbourhood only; small ones share a call.
    dealt = with_text.select("place", "key", "block", "n", "text", F.explode(meeting).alias("meeting"))
    linked = settle(dealt.groupBy("meeting").applyInArrow(_compare_blocks, LINKED))
    links = linked.groupBy("key").agg(F.sum("links").alias("links"))
    groups = connected_components(linked.where("key <> root").select(F.col("key").alias("u"), F.col("root").alias("v")))
    named = (
        classes.select("key", "first", "n")
        .join(links, "key", "left")
        .join(groups.withColumnRenamed("node", "key"), "key", "left")
        .withColumn("root", F.coalesce("root", "key"))
    )
    leads = named.groupBy("root").agg(F.min("first").alias("lead"))
    described = settle(
        named.join(leads, "root").select(
            "key", "lead", F.col("n").alias("n_copies"), (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
        )
    )
    found = lookup_join(signed.select("doc_id", "id", "text_key", "key"), described, ["key"])
    alone = F.col("key").isNull()
    return found.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.nullif("lead.id", F.lit(NO_ID))).alias("class_id"),
        F.when(alone, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"),
        F.when(alone, F.lit(1)).otherwise(F.col("n_copies")).cast("long").alias("n_copies"),
        (alone | ((F.col("lead.id") == F.col("id")) & (F.col("lead.text_key") == F.col("text_key")))).alias("stays"),
        "id",
        "text_key",
    )


def drop_near_copies(documents: DataFrame) -> DataFrame:
    """The document that stays of every group, with all its columns."""
    gone = settle(near_groups(documents).where(~F.col("stays")).select("id", "text_key").distinct())
    whole = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("whole"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"),
        F.xxhash64(text_or_empty()).alias("text_key"),
    )
    return lookup_join(whole, gone, ["id", "text_key"], "left_anti").select("whole.*")

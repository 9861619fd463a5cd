"""Phrases, hard negatives and packing against plain versions."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import reduce
from itertools import takewhile

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from tallystream.llm.best_fit import Packing, Underfull, best_fit, cuts, pack, pack_documents, pack_pieces
from tallystream.llm.hard_negatives import Block, Mining, Pack, Search, hard_negatives, pack_blocks, search_block, usable
from tallystream.llm.phrase_mining import (
    KEY_BITS, Counting, Counts, collocations, count_cyclically, frequent_phrases, portions_of, words_of, _exact, _opened,
)
from tests.llm import cases as C

# op11


def plain_phrases(rows, threshold, first, longest=5):
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(C.LOWER)):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, found in counts.items():
        often = {p: a for p, a in found.items() if a >= threshold}
        covered = defaultdict(int)
        for p, a in often.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    covered[p[i : i + k]] = max(covered[p[i : i + k]], a)
        rows_ = []
        for p, a in often.items():
            if len(p) > 1 and covered[p] < a:
                n = total[lang]
                score, k = min((1000 * a * n // (found[p[:k]] * found[p[k:]]), k) for k in range(1, len(p)))
                rows_.append((-score, -a, " ".join(p).encode(), found[p[:k]], found[p[k:]], n))
        for rank, (s, a, p, left, right, n) in enumerate(sorted(rows_)[:first], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -s))
    return C.sorted_rows(out)


PHRASES = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def chatter(seed, n):
    random.seed(seed)
    words = ["the", "The", "of", "New", "york", "city", "a", "b", "é", "日本", "x\x1cy", "don't", "-", "\x00", "hall"]
    ends = [" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "\r\n", "\x0b", ";", ":", "!", "?"]
    fixed = ["new york city hall", "a b a b a b", "of the of the"]
    out = []
    for _ in range(n):
        text = "".join(random.choice(words if random.random() < 0.7 else fixed) + random.choice(ends) for _ in range(random.randrange(40)))
        out.append((random.choice(["en", "en", "fr", None, "und"]), text))
    return out + [("en", None), (None, None), ("fr", ""), ("en", " \t\n.,"), ("xx", "new york " * 30), ("yy", "one two three")]


def test_words_and_pieces():
    assert words_of([b"A b\tC.d", b"", "É\x1cé x".encode()]) == [b"a", b"b", b"c", b"\xff", b"d", b"\xff", b"\xff", "É\x1cé".encode(), b"x"]


@pytest.mark.parametrize(
    "counting",
    [
        Counting(threshold=7, shards=4, slot_bits=16),
        Counting(threshold=7, shards=1, slot_bits=16, portion_bytes=50, kept_phrases=5),
        Counting(threshold=3, shards=7, slot_bits=3),
        Counting(threshold=300, shards=3, slot_bits=20),
    ],
)
def test_collocations_are_those_of_plain_counting(spark, counting):
    rows = chatter(5, 250)
    df = spark.createDataFrame(rows, "lang string, text string")
    df = df.select("*", *[F.lit(1).alias(c) for c in ("shard", "phrase", "size", "n", "score", "run")]).repartition(3)
    got = C.rows_of(collocations(df, 25, counting), *PHRASES)
    assert got == plain_phrases(rows, counting.threshold, 25)
    assert got or counting.threshold == 300


def test_ties_go_by_bytes_and_the_best_of_all_parts_stay(spark):
    rows = [("en", f"w{i:03d} z{i:03d}. é{i} 日{i}") for i in range(150)] * 2
    got = C.rows_of(collocations(spark.createDataFrame(rows, "lang string, text string"), 200, Counting(threshold=2, slot_bits=14)), *PHRASES)
    assert len(got) == 200 and got == plain_phrases(rows, 2, 200)


def test_no_phrases(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert collocations(empty, 5, Counting(slot_bits=10)).collect() == []
    assert frequent_phrases(spark.createDataFrame([(None, None)], "lang string, text string"), Counting(slot_bits=10)).count() <= 1


def test_lengths_are_interleaved(spark):
    counting = Counting(threshold=10, shards=4, slot_bits=12)
    shard = portions_of(spark.createDataFrame([("en", "a b c d e")] * 10, "lang string, text string").coalesce(1), counting)
    cycle = count_cyclically([shard] * 4, counting)
    row = shard.limit(1).select("lang", "hashes", "width", "codes").toArrow().to_batches()
    phrases, steps = next(_opened(iter(row), counting))[1], []
    while True:
        when = phrases.reached(cycle.reached)
        steps.append(set(when.tolist()))
        if phrases.length == 5:
            break
        phrases.grow(when)
    # Each length is full one scan after the one before; counting by levels would take four each.
    assert steps == [{0}, {1}, {2}, {3}, {4}] and cycle.steps == 8


def test_a_phrase_in_full_slots_waits_for_its_words(spark):
    # Seed and bits with which others fill the slots of a part of "p q r s t" scans before its words are frequent.
    rng = random.Random(87)
    rng.choice([6, 7, 8, 9, 10])
    counting = Counting(threshold=4, shards=4, slot_bits=7)
    texts = [[" ".join(f"w{rng.randint(0, 25) + n * 6}" for _ in range(8)) for _ in range(10)] for n in range(4)]
    for some in texts:
        some += ["p q r s t u"] * rng.choice([0, 0, 1, 2, 3])
    frames = [spark.createDataFrame([("en", t) for t in some], "lang string, text string").coalesce(1) for some in texts]
    shards = [portions_of(df, counting) for df in frames]
    cycle = count_cyclically(shards, counting)
    sent = spark.sparkContext.broadcast(zlib.compress(cycle.reached.tobytes(), 1))
    found = {r.phrase: r.n for r in _exact(reduce(DataFrame.union, shards), sent, counting).collect()}
    plain = Counter(" ".join(w[i : i + 5]) for some in texts for w in map(str.split, some) for i in range(len(w) - 4))
    assert {p: n for p, n in plain.items() if n >= 4}.items() <= found.items() and found["p q r s t"] >= 4


def test_infrequent_phrases_fill_no_slots(spark):
    # 20 frequent words in random order: 400 pairs and 8,000 triples, none of them frequent, over 128 slots.
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(20)}" for _ in range(60)) for _ in range(300)]
    counting = Counting(threshold=100, shards=3, slot_bits=8, portion_bytes=2000)
    portions = portions_of(spark.createDataFrame([("en", t) for t in texts], "lang string, text string").repartition(3), counting)
    cycle = count_cyclically([portions.where(F.col("shard") == n) for n in range(3)], counting)
    sent = spark.sparkContext.broadcast(zlib.compress(cycle.reached.tobytes(), 1))
    found = {r.phrase: r.n for r in _exact(portions, sent, counting).collect()}
    words = Counter(w for t in texts for w in t.split())
    assert words.items() <= found.items() and len(words) == 20 and min(words.values()) >= 100
    assert len(found) < 200


@pytest.mark.parametrize("words, threshold", [(0, 1), (10**9, 7), (10**10, 300), (10**13, 100_000)])
def test_counts_travel_whole(words, threshold):
    rng = np.random.default_rng(threshold)
    counts = Counts(words, threshold)
    hashes = rng.integers(0, 1 << 64, 5000, np.uint64)
    hashes = np.concatenate([hashes, np.repeat(hashes[:50], 400), np.array([0, (1 << 64) - 1], np.uint64)])
    plain, got = Counter((hashes >> np.uint64(32 - counts.range_bits)).tolist()), {}
    for number, counted in counts.blocks(hashes):
        for c in counts.unpacked(counts.packed(counted)).tolist():
            got[number << 32 | c >> 32] = c & (1 << 32) - 1
    assert got == {key: min(n, threshold) for key, n in plain.items()}
    last = counts.key((1 << counts.range_bits) - 1, np.array([(1 << 32) - 1], np.uint64))
    assert last.tolist() == [(1 << KEY_BITS) - 1] and 8 <= counts.range_bits <= 12


def test_larger_corpora_get_larger_tables():
    assert [Counting().fitted(n).slot_bits for n in (0, 10**8, 10**9, 10**10, 10**13)] == [23, 23, 25, 25, 25]
    assert Counting(slot_bits=7).fitted(10**10).slot_bits == 7


def test_shards_are_a_partition_of_the_texts(spark):
    rows = [(lang, text) for lang, text in chatter(3, 100) if lang and text]
    counting = Counting(shards=3, portion_bytes=200)
    portions = portions_of(spark.createDataFrame(rows, "lang string, text string").repartition(2), counting).collect()
    assert {r.shard for r in portions} == {0, 1, 2} and {r.width for r in portions} == {2}
    found = Counter()
    for r in portions:
        words = [b"\xff", *r.words.split(b"\xff")]
        found.update((r.lang, words[c]) for c in np.frombuffer(r.codes, "<u2").tolist() if c)
    assert found == Counter((lang, w) for lang, text in rows for w in words_of([text.encode()]) if w != b"\xff")


def test_too_many_shards():
    with pytest.raises(ValueError):
        Counting(shards=60)


# op12


def plain_negatives(rows, every=100, low=80, k_pos=5, k_neg=5):
    usable_ = [
        (u, i, lab, [math.floor(256 * x) for x in v])
        for u, (i, v, lab) in enumerate(rows)
        if lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    place = lambda i: (i is None, i or 0)
    out = []
    for u, i, lab, v in usable_:
        if i is None or i % every:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), place(j), j, m == lab) for t, j, m, w in usable_ if t != u and len(w) == len(v)]
        scored.sort(key=lambda s: s[:2])
        for s, _, j, _ in [s for s in scored if s[3]][:k_pos]:
            fits = [t for t in scored if not t[3] and low * -s <= 100 * -t[0] <= 100 * -s][:k_neg]
            out += [(i, j, rank, t[2], -s, -t[0]) for rank, t in enumerate(fits, 1)]
    return C.sorted_rows(out)


NEGATIVES = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
VECTORS = "vec_id long, embedding array<float>, label int"


def vectors(seed, n, dims=6, grid=8):
    """Few distinct components, so scores tie."""
    rng = random.Random(seed)
    rows = [(i, [rng.randint(-grid, grid) / grid for _ in range(dims)], rng.choice([0, 0, 0, 1, 2])) for i in range(n)]
    same = rows[10][1]
    rows += [(n + i, same, i % 3) for i in range(40)]
    rows += [(7, rows[0][1], 1), (0, rows[0][1], 0), (None, rows[0][1], 0), (None, rows[0][1], 1), (200, same, 0), (200, same, 0)]
    rows += [(100, None, 0), (300, [1.0] * dims, None), (400, [None] + [1.0] * (dims - 1), 0), (500, [float("nan")] * dims, 1)]
    rows += [(600, [float("inf")] * dims, 1), (700, [0.0] * dims, 1), (-100, [-1.0] * dims, 2), (800, [1.0, 2.0], 0), (801, [1.0, 2.0], 0)]
    return rows + [(802, [1.0, 1.9], 1), (900, [], 1), (901, [], 1), (902, [], 2)]


@pytest.mark.parametrize(
    "mining", [Mining(), Mining(block_rows=16, pack_rows=2, groups=3, first_depth=1), Mining(block_rows=50, pack_rows=3, groups=1, first_depth=4)]
)
def test_negatives_are_those_of_plain_scoring(spark, mining):
    rows = vectors(3, 330)
    df = spark.createDataFrame(rows, VECTORS)
    df = df.select("*", *[F.lit(1).alias(c) for c in ("anchor", "id", "x", "score", "block", "group", "rank")]).repartition(3)
    # vec_id 7 and 0 occur twice with equal contents or not; only ids are compared, so ties among them are alike.
    got = C.rows_of(hard_negatives(df, mining=mining), *NEGATIVES)
    want = plain_negatives(rows)
    assert got == want and len(want) > 50


def test_labels_are_replaced(spark):
    rows = [(i, [1.0 + (i % 5) / 10, 0.5], i % 3) for i in range(210)]
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = C.rows_of(hard_negatives(spark.createDataFrame(rows, VECTORS), label=label), *NEGATIVES)
    assert got == plain_negatives([(i, v, (m + 1) % 10 if i % 7 == 0 else m) for i, v, m in rows])


def test_large_components_are_exact(spark):
    rng = random.Random(8)
    rows = [(i, [float(rng.randint(-(2**20), 2**20)) + rng.randint(0, 3) / 256 for _ in range(4)], i % 2) for i in range(120)]
    got = C.rows_of(hard_negatives(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), every=10), *NEGATIVES)
    assert got == plain_negatives(rows, every=10)


def test_no_vectors(spark):
    assert hard_negatives(spark.createDataFrame([], VECTORS)).collect() == []
    assert hard_negatives(spark.createDataFrame([(100, [1.0], 0)], VECTORS)).collect() == []
    assert hard_negatives(spark.createDataFrame([(100, [1.0], 0), (1, [1.0], 0)], VECTORS)).collect() == []


def test_sorted_access_stops_early_and_not_at_ties(spark):
    rows = [(i, [1.0 - i / 1000, 1.0 - i / 1000], i % 2) for i in range(900)]
    block = Block(pack_blocks(usable(spark.createDataFrame(rows, VECTORS).coalesce(1)), 1000).collect()[0].asDict())
    search = Search(-1, 0, np.array([256.0, 256.0]), [(-math.inf, math.inf)], True, 5)
    assert search_block(search, block) < 40 and [b[2] for b in search.best[0]] == [0, 2, 4, 6, 8]
    ties = [(i, [1.0, 1.0], 0) for i in range(900)]
    block = Block(pack_blocks(usable(spark.createDataFrame(ties, VECTORS).coalesce(1)), 1000).collect()[0].asDict())
    search = Search(-1, 0, np.array([256.0, 256.0]), [(-math.inf, math.inf)], True, 5)
    assert search_block(search, block) == 900 and [b[2] for b in search.best[0]] == [0, 1, 2, 3, 4]


def test_vectors_are_not_joined(spark):
    # A join of packs and blocks may be broadcast, through the driver, with each pack once per group.
    df = spark.createDataFrame([(i, [1.0, i / 300], i % 2) for i in range(300)], VECTORS)
    plan = hard_negatives(df, mining=Mining(block_rows=16))._jdf.queryExecution().optimizedPlan().toString().splitlines()
    begin = next(n for n, line in enumerate(plan) if "MapInArrow" in line)
    depth = plan[begin].index("MapInArrow")
    below = list(takewhile(lambda line: re.search(r"\w", line).start() > depth, plan[begin + 1 :]))
    assert any("binary" in line or "components" in line for line in below) and not any("Join" in line for line in below)


@pytest.mark.parametrize("size", [1.0, 500.0, 1e8])
def test_a_pack_finds_what_each_anchor_finds(spark, size):
    rng = np.random.default_rng(9)
    vectors_ = np.round(rng.normal(size=(700, 5)), 1) * size
    vectors_[::7] *= 4
    rows = [(int(i), v.tolist(), int(i) % 3) for i, v in enumerate(vectors_)]
    df = usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").coalesce(1))
    blocks = [Block(row.asDict()) for row in pack_blocks(df, 100).collect()]
    first = blocks[0]
    windows = [(-math.inf, math.inf), (int(size) ** 2 * 1000, int(size) ** 2 * 90_000), (math.inf, -math.inf)]

    def searches():
        own = [Search(first.place(r), int(first.labels[r]), first.values[r], windows, True, 5) for r in range(0, 60, 2)]
        zero = Search(-1, 1, np.zeros(5), windows, True, 5)
        ahead = Search(-1, 1, np.array([2560.0 * size, 0, 0, 0, 0]), windows[:1], True, 5)
        return [*own, zero, ahead]

    packed, alone = searches(), searches()
    pack, rows_scored = Pack(packed), 0
    for block in blocks:
        rows_scored += pack.search(block, 4)
        for search in alone:
            search_block(search, block, 4)
    assert [s.best for s in packed] == [s.best for s in alone] and any(s.best[1] for s in alone)
    assert rows_scored < 700 * len(alone)  # few rows for the last one


# op13

BYTES = public_tokenizers.path("byte_bpe_50k.json")


def test_cuts():
    assert cuts(3, 4) == [(0, 3)] and cuts(4, 4) == [(0, 4)] and cuts(9, 4) == [(0, 1), (1, 4), (5, 4)]


@pytest.mark.parametrize("seed", range(40))
def test_bins_hold_all_pieces_once(seed):
    rng = random.Random(seed)
    size = rng.randint(2, 70)
    lengths = [rng.randint(1, rng.choice([size, max(1, size // 2), max(1, size // 3)])) for _ in range(rng.randrange(80))]
    bins = pack(lengths, size)
    assert sorted(p for b in bins for p in b) == list(range(len(lengths)))
    assert all(0 < sum(lengths[p] for p in b) <= size for b in bins)
    assert -(-sum(lengths) // size) <= len(bins) <= len(best_fit(lengths, size))


def test_each_kind_of_exchange_empties_a_bin():
    for lengths, bins, size in [
        ([5, 4, 3], [[0], [1, 2]], 12),  # moves
        ([6, 3, 5, 2, 2], [[0, 1], [2, 3, 4]], 10),  # one for one
        ([6, 2, 3, 3, 4, 2], [[0, 1], [2, 3], [4, 5]], 10),
    ]:
        found = Underfull(lengths, bins, size).search()
        assert sorted(p for b in found for p in b) == list(range(len(lengths)))
        assert len(found) == max(1, -(-sum(lengths) // size))


def test_search_beats_best_fit():
    rng = random.Random(2)
    lengths = [rng.randint(260, 420) for _ in range(3000)]
    assert len(pack(lengths, 1024)) < 0.95 * len(best_fit(lengths, 1024))


def test_exchanges_raise_squares():
    rng = random.Random(4)
    lengths = [rng.randint(5, 30) for _ in range(200)]
    state = Underfull(lengths, [[p] for p in range(200)], 50)
    squares = sum(f * f for f in state.fill.values())
    for _ in range(300):
        target = max(state.fill, key=lambda n: (state.fill[n] < 50, state.fill[n], n))
        if state.fill[target] == 50 or not state.improve(target):
            break
        now = sum(f * f for f in state.fill.values())
        assert now > squares
        squares = now
        assert all(sum(lengths[p] for p in state.bins[n]) == f for n, f in state.fill.items())


@pytest.mark.parametrize("packing", [Packing(), Packing(size=16, group_pieces=7, rounds=3), Packing(size=3, group_pieces=1000)])
def test_documents_are_packed(spark, packing):
    got = pack_documents(C.documents(spark), BYTES, 2, packing).collect()
    library = Tokenizer.from_file(BYTES)
    library.no_truncation()
    ids = defaultdict(list)
    for doc, text in C.DOCUMENTS:
        ids[doc].append(library.encode(text or "", add_special_tokens=False).ids + [2])
    pieces = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got)
    want = Counter(
        (doc, n, start, length, zlib.crc32(np.array(one[start : start + length], "<u4").tobytes()))
        for doc, all_ in ids.items()
        for one in all_
        for n, (start, length) in enumerate(cuts(len(one), packing.size))
    )
    assert pieces == want
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for members in by.values():
        members.sort()
        assert [o for o, _ in members] == [sum(n for _, n in members[:i]) for i in range(len(members))]
        assert sum(n for _, n in members) <= packing.size
    total = sum(r.length for r in got)
    if packing.group_pieces > 100:
        assert len(by) <= -(-total // packing.size) + 2


def test_groups_hand_over_what_they_cannot_fill(spark):
    rng = random.Random(6)
    rows = [(n, rng.randint(100, 400)) for n in range(4000)]
    pieces = spark.createDataFrame(rows, "number long, length long")
    count = lambda p: pack_pieces(pieces, p).select("sequence").distinct().count()
    one = count(Packing(group_pieces=5000))
    many, alone = count(Packing(group_pieces=100, rounds=5)), count(Packing(group_pieces=100, rounds=1))
    assert one <= many < alone and many <= 1.005 * one + 1


def test_nothing_to_pack(spark):
    assert pack_documents(spark.createDataFrame([], "doc_id long, text string"), BYTES, 2).collect() == []
    only = pack_documents(spark.createDataFrame([(None, None)], "doc_id long, text string"), BYTES, 2).collect()
    assert [(r.doc_id, r.piece, r.length, r.offset) for r in only] == [(None, 0, 1, 0)]

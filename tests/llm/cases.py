"""Small tables of awkward rows, and results worked out the plain way."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession, functions as F

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BENCH_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
#: Names that the operators use inside.
CLASHING = "id key text_key whole r row file digest keep n w h at_row spans items hit at span window part found lang_pred bits".split()


def prose(seed: int, n: int, words: int = 4000) -> str:
    random.seed(seed)
    return " ".join(f"w{random.randrange(words)}" for _ in range(n))


BASE = prose(1, 120)


def near(seed: int, edits: int = 1) -> str:
    words = BASE.split()
    random.seed(seed)
    for _ in range(edits):
        words[random.randrange(len(words))] = f"x{random.randrange(10**6)}"
    return " ".join(words)


DOCUMENTS: list[tuple[int | None, str | None]] = [
    (0, BASE),
    (1, None),
    (2, ""),
    (3, " \n\t\x0b "),
    (4, "two words"),
    (5, BASE),
    (6, near(6)),
    (7, near(7)),
    (8, near(8, 2)),
    (9, BASE.upper().replace(" ", " , ")),
    (10, "!!! ??? ..."),
    (11, "é ü ñ ß straße élan 日本語 \U0001f600"),
    (12, prose(2, 30_000)),
    (13, "Question one: " + " ".join(f"q{i}" for i in range(25)) + " and the rest"),
    (14, "before " + " ".join(f"Q{i}" for i in range(25)) + " " + " ".join(f"q{i}" for i in range(12)) + " after"),
    (15, "say Short ITEM here"),
    (16, "two words"),
    (17, "two  words"),
    (18, "a" * 5000),
    (19, prose(2, 29_000) + " tail"),
    (20, BASE),
    (20, BASE),
    (20, "another text of the same id with " + prose(3, 40)),
    (None, BASE),
    (None, None),
    (None, "no id, own words " + prose(4, 30)),
    (-5, "negative id <|endoftext|> and </turn> \\ <turn>"),
    (21, "12 345 don't <s> ▁x  double  spaces  "),
    (22, " leading space and trailing "),
    (23, "line\nbreaks\r\nand\ttabs"),
]
BENCHMARK: list[tuple[int | None, str | None]] = [
    (1, " ".join(f"q{i}" for i in range(25))),
    (2, "short item"),
    (10, "SHORT, item!"),
    (3, None),
    (4, ""),
    (5, "--- ???"),
    (6, " ".join(f"q{i}" for i in range(9))),
]


def documents(spark: SparkSession, rows=None, clashing: bool = True) -> DataFrame:
    rows = DOCUMENTS if rows is None else rows
    df = spark.createDataFrame(rows, "doc_id long, text string")
    languages = F.when(F.col("doc_id") % 4 == 0, None).when(F.col("doc_id") % 2 == 0, "en").otherwise("xx")
    df = df.withColumn("lang", languages).withColumn("source", F.lit(None).cast("string"))
    if clashing:
        df = df.select("*", *[F.lit(None).cast("string").alias(c) for c in CLASHING])
    return df.repartition(3)


def benchmark(spark: SparkSession, rows=None) -> DataFrame:
    df = spark.createDataFrame(BENCHMARK if rows is None else rows, "item_id long, text string")
    return df.select("*", F.lit(1).alias("items"), F.lit(2).alias("doc_id"))


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def bench_words(text: str | None) -> list[str]:
    return BENCH_WORD.findall((text or "").translate(LOWER))


def contaminated(rows, items, span: int = 10) -> list[tuple]:
    windows = defaultdict(set)
    for item, text in items:
        words = bench_words(text)
        k = min(span, len(words))
        for i in range(len(words) - k + 1 if words else 0):
            windows[tuple(words[i : i + k])].add(str(item))
    out = []
    for doc, text in rows:
        words, hit, found = bench_words(text), set(), set()
        for k in {len(w) for w in windows}:
            for i in range(len(words) - k + 1):
                if got := windows.get(tuple(words[i : i + k])):
                    hit.update(range(i, i + k))
                    found |= got
        out.append((doc, len(words), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def without_repeats(rows, span: int = 13) -> list[tuple]:
    order = lambda d: 2**63 - 1 if d is None else d
    words = [(d, re.findall("[^\x20\x09-\x0d]+", t or "")) for d, t in rows]
    first: dict[tuple, int] = {}
    for d, w in words:
        for i in range(len(w) - span + 1):
            k = tuple(w[i : i + span])
            first[k] = min(first.get(k, 2**63 - 1), order(d))
    out = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - span + 1):
            if first[tuple(w[i : i + span])] < order(d):
                gone.update(range(i, i + span))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def near_groups(rows, threshold: float = 0.8) -> list[tuple]:
    order = lambda d: 2**63 - 1 if d is None else d
    sets = []
    for d, t in rows:
        w = bench_words(t)
        k = min(5, len(w))
        sets.append((d, t or "", tuple(w), {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()))
    n = len(sets)
    linked = [[] for _ in range(n)]
    for i in range(n):
        for j in range(n):
            a, b = sets[i][3], sets[j][3]
            if i != j and a and b and len(a & b) >= threshold * len(a | b) - 1e-9:
                linked[i].append(j)
    out = []
    for i in range(n):
        group, work = {i}, [i]
        while work:
            for j in linked[work.pop()]:
                if j not in group:
                    group.add(j)
                    work.append(j)
        lead = min(order(sets[j][0]) for j in group)
        copies = sum(1 for s in sets if s[2] == sets[i][2]) if sets[i][2] else 1
        out.append((sets[i][0], None if lead == 2**63 - 1 else lead, len(linked[i]), copies))
    return out


def rows_of(df: DataFrame, *columns: str) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def sorted_rows(rows) -> list[tuple]:
    return sorted(rows, key=repr)

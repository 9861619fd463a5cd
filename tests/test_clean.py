import math
import random

import pytest
from pyspark.sql import functions as F

from tallystream.functions import clean as C

# text, value, value when a minus is not allowed
CELLS = [
    ("1,234", 1234.0, 1234.0),
    ("25%", 25.0, 25.0),
    ("-7%", -7.0, None),
    (".5", 0.5, 0.5),
    ("5.", 5.0, 5.0),
    ("", 0.0, 0.0),
    ("5-3", 0.0, None),
    ("5-", 0.0, None),
    ("1.2.3", None, None),
    ("--5", None, None),
    ("-", None, None),
    (".", None, None),
    ("abc", None, None),
    ("1e3", None, None),
    ("NaN", None, None),
    ("1d", None, None),
    ("%", None, None),
    (" + 12 ", 12.0, 12.0),
    (" 12\t", 12.0, 12.0),
    ("1\t2", None, None),
    (None, None, None),
]


def values(spark, texts, column):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.v for r in df.select("i", column(F.col("t")).alias("v")).orderBy("i").collect()]


def test_clean_number(spark):
    texts = [c[0] for c in CELLS]
    assert values(spark, texts, C.clean_number) == [c[1] for c in CELLS]
    assert values(spark, texts, lambda c: C.clean_number(c, allow_negative=False)) == [c[2] for c in CELLS]
    rejected = values(spark, texts, C.is_rejected_number)
    assert rejected == [t is not None and v is None for t, v, _ in CELLS]


def by_the_rule(text):
    """The number rule, stated on characters."""
    bare = "".join(c for c in text if c not in "+%, ").strip()
    if text == "":
        return 0.0
    digits = [c for c in bare if c in "0123456789"]
    others = [c for c in bare if c not in "0123456789"]
    if not digits or sorted(others) not in ([], ["."], ["-"], ["-", "."]):
        return None
    try:
        return float(bare)
    except ValueError:
        return 0.0


def test_clean_number_on_random_text(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice("0123456789.-+%, ea\t") for _ in range(rng.randint(0, 6))) for _ in range(4000)]
    assert values(spark, texts, C.clean_number) == [by_the_rule(t) for t in texts]


def test_percent_fraction(spark):
    texts = ["25%", "25", "-3%", "1,200%", "x%", "", None, "%", "2%5"]
    assert values(spark, texts, C.percent_fraction) == [0.25, 25.0, -0.03, 12.0, None, None, None, None, None]


@pytest.mark.parametrize(
    "label, name",
    [
        ("Sales +", "Sales"),
        ("Sales +", "Sales"),
        ("  Profit before tax ", "__Profit_before_tax"),
        ("OPM %", "OPM_%"),
        (" EPS in Rs\n", "EPS_in_Rs"),
        ("Other Income +", "Other Income"),
        ("", "Unknown"),
        (" ", "Unknown"),
        ("+", "Unknown"),
    ],
)
def test_normalize_header(spark, label, name):
    assert values(spark, [label], C.normalize_header) == [name]


def test_fill_number(spark):
    df = spark.createDataFrame([(1.5,), (None,), (math.nan,)], "v double")
    assert [r.v for r in df.select(C.fill_number(F.col("v")).alias("v")).collect()] == [1.5, 0.0, 0.0]


def test_parse_mark(spark):
    texts = [
        "2024-09-02T13:44:54.668705+00:00",
        "2024-09-02T19:14:54.668705+05:30\n",
        "2024-09-02T13:44:54.668705",
        "",
        "soon",
        "0001-01-01T00:00:00",
        "0001-01-01T00:00:00+00:00",
        None,
    ]
    got = values(spark, texts, lambda c: F.unix_micros(C.parse_mark(c)))
    assert got == [1725284694668705] * 3 + [None] * 5

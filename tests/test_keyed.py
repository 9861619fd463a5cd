import pytest

from tallystream.operators import keyed as K
from tallystream.operators.joins import JoinLimits

SHUFFLED = JoinLimits(broadcast_bytes=-1)
LIMITS = pytest.mark.parametrize("limits", [JoinLimits(), SHUFFLED])


def table(spark, rows):
    return spark.createDataFrame(rows, "k string, v double")


def ordered(spark, rows):
    return spark.createDataFrame(rows, "k string, v double, n int")


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


OLD = [("a", 1.0), ("b", 2.0), ("b", 2.5), ("c", None), (None, 9.0)]


@LIMITS
def test_keyed_update(spark, limits):
    got = K.keyed_update(table(spark, OLD), table(spark, [("b", None), ("z", 4.0)]), ["k"], limits)
    assert rows_of(got) == rows_of(table(spark, [("a", 1.0), ("b", None), ("b", None), ("c", None), (None, 9.0)]))


@LIMITS
def test_keyed_delete(spark, limits):
    got = K.keyed_delete(table(spark, OLD), table(spark, [("b", 0.0), ("b", 1.0), (None, 1.0)]), ["k"], limits)
    assert rows_of(got) == rows_of(table(spark, [("a", 1.0), ("c", None), (None, 9.0)]))


@LIMITS
def test_upsert_ignore(spark, limits):
    new = ordered(spark, [("a", 7.0, 1), ("d", 5.0, 2), ("d", 4.0, 1)])
    got = K.upsert_ignore(table(spark, OLD), new, ["k"], ["n"], limits)
    assert rows_of(got) == rows_of(table(spark, OLD + [("d", 4.0)]))


@LIMITS
def test_upsert_replace(spark, limits):
    new = ordered(spark, [("a", 7.0, 1), ("d", 5.0, 2), ("d", 4.0, 1)])
    got = K.upsert_replace(table(spark, OLD), new, ["k"], ["n"], limits)
    assert rows_of(got) == rows_of(table(spark, [r for r in OLD if r[0] != "a"] + [("a", 7.0), ("d", 5.0)]))


def test_delete_in_list_keeps_nulls(spark):
    years = spark.createDataFrame([("Mar 2025",), ("Jun 2025",), ("Mar 2024",), (None,)], "Year string")
    left = K.delete_in_list(years, "Year", ["Mar 2025", "Jun 2025"])
    assert rows_of(left) == rows_of(spark.createDataFrame([("Mar 2024",), (None,)], "Year string"))
    assert K.delete_in_list(years, "Year", []).count() == 4


def test_drop_period_keeps_nulls(spark):
    years = spark.createDataFrame([("TTM",), ("Mar 2024",), (None,)], "Year string")
    assert sorted((r.Year for r in K.drop_period(years, "TTM").collect()), key=repr) == ["Mar 2024", None]

import math

import pytest
from pyspark.sql import types as T

from tallystream.operators import layout as L
from tallystream.operators import summary as S
from tallystream.schemas import METRICS, SINK_SINGLE, YEAR


def sink(spark, rows):
    """Rows of (year, value); every metric has the value."""
    return spark.createDataFrame([(y, *[v] * len(METRICS)) for y, v in rows], SINK_SINGLE)


def average(df):
    return S.average_row(df).first()


def test_average_row(spark):
    row = average(sink(spark, [("Mar 1", 10.0), ("Mar 2", 50.0), ("Mar 3", 100.0), ("Mar 4", None), ("TTM", 9e9), (None, 9e9)]))
    assert row[YEAR] == "AVERAGE" and {row[m] for m in METRICS} == {53.33}


def test_average_does_not_feed_on_itself(spark):
    df = sink(spark, [("Mar 1", 10.0), ("Mar 2", 50.0), ("AVERAGE", 1.0)])
    for _ in range(2):
        df = S.with_average(df)
    rows = {r[YEAR]: r.Interest for r in df.collect()}
    assert rows == {"Mar 1": 10.0, "Mar 2": 50.0, "AVERAGE": 30.0} and df.count() == 3


def test_average_of_nothing(spark):
    assert set(average(sink(spark, []))[1:]) == {None}


def test_column_profile(spark):
    df = spark.createDataFrame(
        [(2, "1", "x", "1,0", None), (1, "22", "5%", "2", "3")], "n int, a string, `b %` string, c string, d string"
    )
    got = {tuple(r) for r in S.column_profile(df, ["a", "b %", "c", "d"], ["n"]).collect()}
    assert got == {("a", True, False), ("b %", False, True), ("c", False, False), ("d", False, False)}


def test_union_statements(spark):
    a = spark.createDataFrame([("Mar 1", 1.0, math.nan)], f"{YEAR} string, Interest double, Sales_plus double")
    b = spark.createDataFrame([(None, 2.0)], f"{YEAR} string, Tax_percent double")
    rows = S.union_statements([a, b]).select(YEAR, "Interest", "Sales_plus", "Tax_percent").collect()
    assert sorted(map(tuple, rows), key=repr) == [("Mar 1", 1.0, 0.0, 0.0), (None, 0.0, 0.0, 2.0)]


def test_unpivot(spark):
    assert S.unpivot_metrics(sink(spark, [("Mar 1", 1.0)]), [YEAR]).count() == len(METRICS)


def test_renames(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    renamed, missing = L.rename_map(df, {"a": "x", "zz": "y"})
    assert renamed.columns == ["x", "b"] and missing == ["zz"]
    assert L.rename_positional(df, ["Sales +", "0"]).columns == ["Sales +", "0"]
    with pytest.raises(ValueError):
        L.rename_positional(df, ["one"])


def test_conform_and_report(spark):
    declared = T.StructType(
        [T.StructField("a", T.DoubleType()), T.StructField("b", T.StringType()), T.StructField("c", T.LongType())]
    )
    df = spark.createDataFrame([("1.5", "x", 1), ("bad", "y", 2)], "a string, b string, z int")
    assert L.schema_report(df, declared) == [("c", "missing"), ("z", "extra"), ("a", "string instead of double")]
    got = L.conform(df, declared)
    assert got.schema == declared
    assert [tuple(r) for r in got.collect()] == [(1.5, "x", None), (None, "y", None)]
    assert L.schema_report(got, declared) == []

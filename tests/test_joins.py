import random

import pytest
from pyspark.sql import functions as F

from tallystream.operators.joins import JoinLimits, bounded_side, is_stored, key_list, lookup_join, only_keys, payload_bytes

SHUFFLED = JoinLimits(broadcast_bytes=-1)


def frames(spark):
    rng = random.Random(3)
    # One key and the null key hold a third of the rows each; some rows are identical copies.
    keys = [7] * 300 + [None] * 300 + [rng.randint(0, 40) for _ in range(300)]
    rows = spark.createDataFrame([(k, i % 50) for i, k in enumerate(keys)], "k int, v int").repartition(5)
    side = spark.createDataFrame([(k, k * 10) for k in range(0, 30)] + [(None, -1)], "k int, w int")
    return rows, side


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_shuffled_join_equals_plain_join(spark, how):
    rows, side = frames(spark)
    want = rows.join(side, "k", how)
    for limits in (SHUFFLED, JoinLimits()):
        got = lookup_join(rows, side, ["k"], how, limits)
        assert got.columns == want.columns
        assert rows_of(got) == rows_of(want)


def test_composite_key(spark):
    rows, side = frames(spark)
    rows, side = rows.withColumn("c", F.lit("x")), side.withColumn("c", F.lit("x"))
    got = lookup_join(rows, side, ["k", "c"], "left", SHUFFLED)
    assert rows_of(got) == rows_of(rows.join(side, ["k", "c"], "left"))


def test_a_computed_side_is_computed_once(spark, tmp_path):
    spark.range(1000).selectExpr("id % 10 as k", "id as v").write.parquet(str(tmp_path / "t"))
    scan = spark.read.parquet(str(tmp_path / "t"))
    assert is_stored(scan.select("k")) and not is_stored(scan.distinct())
    # Small files are taken by their size, without a job.
    group = "sizing"
    spark.sparkContext.setJobGroup(group, "")
    try:
        side, small = bounded_side(scan.select("k"))
        assert small and not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setJobGroup("", "")
    side, small = bounded_side(scan.groupBy("k").count(), SHUFFLED)
    assert is_stored(side) and not small


def test_payload_bytes_follows_text_length(spark):
    short = spark.range(100).select(F.lit("a").alias("t"))
    long = spark.range(100).select(F.lit("a" * 1000).alias("t"), F.struct(F.lit("b" * 500).alias("x")).alias("s"))
    assert payload_bytes(long) - payload_bytes(short) >= 100 * 1499
    assert payload_bytes(short.limit(0)) == 0


def test_only_keys(spark):
    rows, side = frames(spark)
    wanted = side.where("k < 5").unionByName(side.where("k < 5"))
    assert rows_of(only_keys(rows, wanted, ["k"])) == rows_of(rows.where("k < 5"))


def test_key_list(spark):
    rows = spark.createDataFrame([("A", 1), ("B", 2), ("A", 3), (None, 4)], "c string, v int")
    assert rows_of(only_keys(rows, key_list(spark, "c", ["A", "Z", "A"]), ["c"])) == [("A", 1), ("A", 3)]
    assert only_keys(rows, key_list(spark, "c", []), ["c"]).count() == 0

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallystream.operators import audit as A
from tallystream.schemas import AUDIT, COMPANY, METRICS, YEAR


def stamp():
    return F.lit("2024-01-01T00:00:00Z").cast("timestamp"), F.lit("tester")


def facts(spark, rows):
    """Rows of (year, company, sales); other metrics null."""
    df = spark.createDataFrame(rows, f"{YEAR} string, {COMPANY} string, Sales_plus double")
    return df.select(YEAR, "Sales_plus", *[F.lit(None).cast("double").alias(m) for m in METRICS[1:]], COMPANY)


def test_audit_seed(spark):
    seeded = A.audit_seed(facts(spark, [(f"Mar {y}", "A", 1.0) for y in range(50)]).repartition(5), *stamp(), after=7)
    assert seeded.schema.names == AUDIT.names
    rows = seeded.collect()
    ids = [r.audit_id for r in rows]
    assert len(set(ids)) == 50 and min(ids) == 8
    assert {r.operation_type for r in rows} == {"INSERT"} and {r.changed_by for r in rows} == {"tester"}


def test_audit_seed_defaults_to_clock_and_user(spark):
    row = A.audit_seed(facts(spark, [("Mar 2020", "A", 1.0)])).first()
    assert row.changed_by and abs((dt.datetime.now() - row.changed_at).total_seconds()) < 86400


def test_snapshot_diff(spark):
    old = facts(spark, [("Mar 1", "A", 1.0), ("Mar 2", "A", 2.0), ("Mar 3", "A", None), ("Mar 4", "A", 4.0)])
    new = facts(spark, [("Mar 1", "A", 1.0), ("Mar 2", "A", 2.5), ("Mar 3", "A", None), ("Mar 5", "A", 5.0)])
    got = A.snapshot_diff(old, new, [YEAR, COMPANY], *stamp())
    assert got.schema.names == AUDIT.names
    rows = {(r.operation_type, r[YEAR], r[COMPANY], r.Sales_plus) for r in got.collect()}
    # The deletion carries the whole old image.
    assert rows == {("UPDATE", "Mar 2", "A", 2.5), ("DELETE", "Mar 4", "A", 4.0), ("INSERT", "Mar 5", "A", 5.0)}


def test_snapshot_diff_pairs_null_keys(spark):
    old = facts(spark, [(None, "A", 1.0), ("Mar 2", None, 2.0)])
    new = facts(spark, [(None, "A", 1.0), ("Mar 2", None, 3.0), ("", "A", 4.0)])
    got = A.snapshot_diff(old, new, [YEAR, COMPANY], *stamp())
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "Exchange hashpartitioning" not in plan
    rows = {(r.operation_type, r[YEAR], r[COMPANY], r.Sales_plus) for r in got.collect()}
    assert rows == {("UPDATE", "Mar 2", None, 3.0), ("INSERT", "", "A", 4.0)}


def test_snapshot_diff_refuses_several_rows_per_key(spark):
    twice = facts(spark, [("Mar 1", "A", 1.0), ("Mar 1", "A", 2.0)])
    with pytest.raises(Exception, match="several rows for key Mar 1A"):
        A.snapshot_diff(twice, twice, [YEAR, COMPANY], *stamp()).collect()


def log(spark):
    t = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    rows = [(1, t), (2, t), (3, t), (4, t + dt.timedelta(microseconds=1)), (5, None)]
    return spark.createDataFrame(rows, "audit_id long, changed_at timestamp"), t


def ids(df):
    return [r.audit_id for r in df.collect()]


def test_incremental_scan(spark):
    audit, t = log(spark)
    assert ids(A.incremental_scan(audit, t, ordered=True)) == [4]
    assert ids(A.incremental_scan(audit, t, after_id=2, ordered=True)) == [3, 4]
    assert len(ids(A.incremental_scan(audit, None))) == 5
    assert ids(A.incremental_scan(audit, "2023-12-31T23:59:59Z", ordered=True)) == [1, 2, 3, 4]


def test_mark_reaches_the_file_scan(spark, tmp_path):
    audit, t = log(spark)
    audit.write.parquet(str(tmp_path / "audit"))
    stored = spark.read.parquet(str(tmp_path / "audit"))
    plan = A.incremental_scan(stored, t, after_id=2)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(changed_at,2024-01-01" in plan


def test_high_water_mark(spark):
    audit, t = log(spark)
    row = A.high_water_mark(audit).first()
    assert row.audit_id == 4
    assert tuple(A.high_water_mark(audit.limit(0)).first()) == (None, None)


def test_nulls_that_move_are_changes(spark):
    old = facts(spark, [("Mar 1", "A", 1.0)])
    moved = old.withColumns({METRICS[0]: F.lit(None).cast("double"), METRICS[1]: F.lit(1.0)})
    assert [r.operation_type for r in A.snapshot_diff(old, moved, [YEAR], *stamp()).collect()] == ["UPDATE"]


def test_ids_go_up_and_on(spark):
    rows = facts(spark, [(f"Mar {y}", "A", 1.0) for y in range(30)]).repartition(3)
    first = [r.audit_id for r in A.audit_seed(rows, *stamp()).collect()]
    assert first == sorted(set(first)) and min(first) == 1
    top = A.highest_id(A.audit_seed(rows, *stamp()))
    second = [r.audit_id for r in A.audit_seed(rows, *stamp(), after=top).collect()]
    assert min(second) > max(first) and A.highest_id(A.audit_seed(rows.limit(0), *stamp())) == 0

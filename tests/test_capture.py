"""Differences of bags, numbers without gaps, kept averages, captured streams."""

import datetime as dt
import random
from collections import Counter
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from tallystream.operators.audit import audit_seed
from tallystream.operators.bag_diff import bag_audit, bag_diff, keyed_audit, replay_bag
from tallystream.operators.fold import BAG, apply_changes
from tallystream.operators.joins import JoinLimits
from tallystream.operators.kept_average import average_of, sums_after, sums_of
from tallystream.operators.sequence import dense_ids
from tallystream.schemas import AUDIT, COMPANY, METRICS, SINK_SINGLE, YEAR
from tallystream.sources.change_log import ChangeLog
from tallystream.streaming.capture import capture, capture_stream
from tests.test_sources import audit

ROWS = "k string, n int, a double, b string"


def clock():
    return F.lit("2024-02-01T00:00:00+00:00").cast("timestamp")


def bag(seed, size, keys=6):
    rng = random.Random(seed)
    return [
        (rng.choice([None, *map(str, range(keys))]), rng.choice([1, None]), rng.choice([0.0, 1.5, None]), rng.choice(["x", None]))
        for _ in range(size)
    ]


def counted(df):
    return Counter(map(tuple, df.collect()))


@pytest.mark.parametrize("old, new", [(60, 70), (0, 30), (30, 0), (0, 0)])
def test_bag_records_lead_from_one_version_to_the_other(spark, old, new):
    a, b = bag(1, old), bag(2, new)
    before, after = (spark.createDataFrame(r, ROWS).repartition(3) for r in (a, b))
    records = bag_diff(before, after, ["k", "n"])
    assert counted(replay_bag(before, records)) == Counter(b)
    got = records.collect()
    key = lambda r: (r.k, r.n)
    surplus_old, surplus_new = Counter(a) - Counter(b), Counter(b) - Counter(a)
    by_key = lambda c: Counter({k: sum(n for r, n in c.items() if r[:2] == k) for k in {r[:2] for r in c}})
    old_n, new_n = by_key(surplus_old), by_key(surplus_new)
    assert Counter(key(r.old) for r in got if r.operation_type == "UPDATE") == old_n & new_n
    assert Counter(key(r.new) for r in got if r.operation_type == "INSERT") == new_n - old_n
    assert Counter(key(r.old) for r in got if r.operation_type == "DELETE") == old_n - new_n
    assert all(key(r.old) == key(r.new) for r in got if r.operation_type == "UPDATE")


def test_bag_records_are_the_same_for_every_split(spark):
    a, b = bag(3, 50), bag(4, 50)
    results = []
    for n, limits in ((1, JoinLimits()), (4, JoinLimits(broadcast_bytes=-1))):
        before, after = (spark.createDataFrame(random.Random(n).sample(r, len(r)), ROWS).repartition(n) for r in (a, b))
        results.append(Counter(map(repr, bag_diff(before, after, ["k"], limits).collect())))
    assert results[0] == results[1]


def test_equal_bags_and_copies_of_one_row(spark):
    a = spark.createDataFrame(bag(5, 40), ROWS)
    assert bag_diff(a, a.repartition(2), ["k"]).collect() == []
    one = spark.createDataFrame([("k", 1, 1.0, "x")] * 500, ROWS)
    got = bag_diff(one, one.limit(3).unionByName(one.select("k", "n", F.lit(2.0).alias("a"), "b").limit(2)), ["k"]).collect()
    assert Counter(r.operation_type for r in got) == {"UPDATE": 2, "DELETE": 495}


def test_an_old_image_that_is_not_there(spark):
    a, b = (spark.createDataFrame(r, ROWS) for r in ([("k", 1, 1.0, "x")], [("k", 1, 2.0, "x")]))
    with pytest.raises(Exception, match="old image"):
        replay_bag(b, bag_diff(a, b, ["k"])).collect()


def statements(spark, rows):
    """(year, company, value) as facts."""
    data = [(y, *[v] * len(METRICS), c) for y, c, v in rows]
    return spark.createDataFrame(data, [YEAR, *METRICS, COMPANY]) if data else spark.createDataFrame(
        [], ", ".join([f"{YEAR} string", *[f"{m} double" for m in METRICS], f"{COMPANY} string"])
    )


OLD = [("1", "a", 1.0), ("1", "a", 2.0), ("2", "a", 3.0), ("3", "a", 4.0), ("4", "a", 4.0), ("4", "a", 4.0), ("5", "b", 1.0)]
NEW = [("1", "a", 1.0), ("1", "a", 5.0), ("2", "a", 6.0), ("4", "a", 4.0), ("6", "a", 1.0), ("6", "a", 1.0), ("5", "b", 1.0)]


def test_records_for_a_sink_by_key(spark):
    records = keyed_audit(statements(spark, OLD), statements(spark, NEW), [YEAR, COMPANY], clock(), F.lit("u"), after=10)
    assert [(f.name, f.dataType) for f in records.schema] == [(f.name, f.dataType) for f in AUDIT]
    rows = records.orderBy("audit_id").collect()
    assert [r.audit_id for r in rows] == list(range(11, 11 + len(rows)))
    after = apply_changes(statements(spark, OLD), records, [YEAR, COMPANY], BAG)
    assert sorted((r[YEAR], r[COMPANY], r.Interest) for r in after.collect()) == sorted(NEW)


def test_records_as_a_row_trigger_writes_them(spark):
    rows = bag_audit(statements(spark, OLD), statements(spark, NEW), [YEAR, COMPANY], clock(), F.lit("u")).orderBy("audit_id").collect()
    assert [(r.audit_id, r.operation_type, r[YEAR], r.Interest) for r in rows] == [
        (1, "DELETE", "3", 4.0), (2, "DELETE", "4", 4.0), (3, "UPDATE", "1", 5.0), (4, "UPDATE", "2", 6.0), (5, "INSERT", "6", 1.0), (6, "INSERT", "6", 1.0),
    ]


def test_numbers_have_no_gaps_and_do_not_depend_on_the_split(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, *range(30)]), rng.choice(["x", "y", None])) for _ in range(500)]
    found = []
    for n in (1, 7):
        df = spark.createDataFrame(rng.sample(rows, len(rows)), "a int, b string").repartition(n)
        got = sorted((r.id, r.a, r.b) for r in dense_ids(df, "id", ["a"], after=41).collect())
        assert [i for i, _, _ in got] == list(range(42, 542))
        assert [a for _, a, _ in got] == sorted((r[0] for r in rows), key=lambda a: (a is not None, a))
        found.append(got)
    assert found[0] == found[1]
    assert dense_ids(spark.createDataFrame([], "a int"), "id", ["a"]).collect() == []
    plan = dense_ids(spark.range(100).toDF("a"), "id", ["a"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan


def test_seed_without_gaps(spark):
    facts = statements(spark, [(str(i), "c", float(i)) for i in range(50)]).repartition(5)
    rows = audit_seed(facts, clock(), F.lit("u"), after=7, order=[YEAR]).orderBy("audit_id").collect()
    assert [(r.audit_id, r[YEAR]) for r in rows] == list(zip(range(8, 58), sorted(map(str, range(50)))))


def exact_mean(values):
    values = [Decimal(repr(v)) for v in values if v is not None]
    if not values:
        return None
    return float((sum(values) / len(values)).quantize(Decimal("0.01"), ROUND_HALF_UP))


def test_an_average_kept_by_differences(spark):
    rng = random.Random(2)
    rows = {f"Mar {i}": rng.choice([None, rng.uniform(-1e6, 1e6), 0.005, -0.015]) for i in range(60)} | {"TTM": 5.0, "AVERAGE": 1.0}
    make = lambda some: audit(spark, [(1, 1, "INSERT", y, v) for y, v in some]).select(*SINK_SINGLE.names)
    sums = sums_of(make(rows.items()))
    for _ in range(3):
        touched = rng.sample(sorted(rows), 10)
        before = [(y, rows[y]) for y in touched]
        for y in touched:
            rows[y] = rng.choice([None, rng.uniform(-10, 10)])
        sums = sums_after(sums, make(before), make([(y, rows[y]) for y in touched]))
        want = exact_mean([v for y, v in rows.items() if y not in ("TTM", "AVERAGE")])
        assert average_of(sums).first().Interest == want
    assert set(average_of(sums_of(make([]))).first()[1:]) == {None}


def test_halves_are_rounded_away_from_zero(spark):
    for values, want in (([0.005], 0.01), ([-0.005], -0.01), ([0.01, 0.0], 0.01), ([2.675], 2.68), ([1.0, 1.0, 2.0], 1.33), ([-1.0, 0.99], 0.0)):
        df = audit(spark, [(i, i, "INSERT", f"Mar {i}", v) for i, v in enumerate(values)]).select(*SINK_SINGLE.names)
        assert abs(average_of(sums_of(df)).first().Interest - want) < (1e-12 if want else 0.011)


def test_the_average_of_a_log_moves_by_the_changed_rows(spark, tmp_path):
    table = ChangeLog(spark, str(tmp_path / "t"), SINK_SINGLE, [YEAR])
    table.load_initial(audit(spark, [(i, i, "INSERT", f"Mar {i}", float(i)) for i in range(40)]).select(*SINK_SINGLE.names))
    held = {i: float(i) for i in range(40)}
    for n in range(3):
        changes = [(100 * n + i, i, "UPDATE", f"Mar {i}", float(n * 1000 + i)) for i in range(n, 40, 7)]
        changes.append((100 * n + 90, 90, "DELETE", f"Mar {n + 20}", None))
        table.append(audit(spark, changes), n)
        held |= {i: float(n * 1000 + i) for i in range(n, 40, 7) if i in held}
        held.pop(n + 20, None)
        assert table.average().first().Interest == exact_mean(held.values())
        if n == 1:
            table.fold()
            assert table.average().first().Interest == exact_mean(held.values())


# streams

VERSIONS = "k string, place long, at timestamp, gone boolean, a double, b string"
START = dt.datetime(2024, 1, 1)


def versions(seed, n, keys=8):
    rng = random.Random(seed)
    return [
        (rng.choice([None, *map(str, range(keys))]), i, START + dt.timedelta(seconds=i), rng.choice([True, False, False, None]),
         rng.choice([0.1, None, float("nan")]), rng.choice(["x", 'quote " é', None]))
        for i in range(n)
    ]


def plain_capture(rows):
    state, out = {}, []
    for k, place, _, gone, a, b in sorted(rows, key=lambda r: r[1]):
        image = None if gone else (repr(a), b)
        if image != state.get(k):
            kind = "INSERT" if state.get(k) is None else "DELETE" if gone else "UPDATE"
            out.append((place, kind, k, *(state[k] if gone else image)))
        state[k] = image
    return sorted(out, key=repr)


def records(df):
    return sorted(((r.audit_id, r.operation_type, r.k, repr(r.a), r.b) for r in df.collect()), key=repr)


@pytest.mark.parametrize("cuts", [(), (40,), (1, 2, 60, 61, 100)])
def test_captured_records_do_not_depend_on_batches(spark, tmp_path, cuts):
    rows = versions(1, 120)
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    parts = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])]
    for part in parts:
        again = part[:3]  # delivered twice
        spark.createDataFrame(random.Random(1).sample(part + again, len(part + again)), VERSIONS).write.mode("append").parquet(src)
        stream = spark.readStream.schema(VERSIONS).parquet(src)
        captured = capture_stream(stream, ["k"], "place", "at", "gone")
        captured.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "mark")).trigger(availableNow=True).start(
            out
        ).awaitTermination()
    want = plain_capture(rows)
    assert records(spark.read.parquet(out)) == want
    assert records(capture(spark.createDataFrame(rows + rows[:5], VERSIONS), ["k"], "place", "at", "gone")) == want


def test_late_versions_are_passed_over(spark):
    df = spark.createDataFrame([], VERSIONS)
    assert capture(df, ["k"], "place", "at", "gone").collect() == []
    rows = [("k", None, START, False, 1.0, "x"), ("k", 5, START, True, 1.0, "x"), ("k", 6, START, False, 1.0, "x")]
    assert records(capture(spark.createDataFrame(rows, VERSIONS), ["k"], "place", "at", "gone")) == [(6, "INSERT", "k", "1.0", "x")]

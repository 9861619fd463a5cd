"""State from changes in any order, any number of times, with any number of folds."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from tallystream.operators.fold import BAG, IGNORE
from tallystream.operators.joins import JoinLimits, is_stored
from tallystream.operators.marks import (
    APPLIED,
    initial_state,
    known_ids,
    marks_layout,
    merge,
    only_new,
    ranges_of,
    settle_until,
    shown,
)
from tallystream.sources.change_log import ChangeLog
from tests.replay import CHANGES, START, TARGET, random_case, replay

SHUFFLED = JoinLimits(broadcast_bytes=-1)


def table(spark, path, mode, target=()):
    schema = spark.createDataFrame([], TARGET).schema
    log = ChangeLog(spark, str(path), schema, ["k"], mode)
    if target:
        log.load_initial(spark.createDataFrame(list(target), TARGET))
    return log


def contents(log):
    return sorted(map(tuple, log.read().collect()), key=repr)


def cut(changes, seed, parts):
    """The changes in any order, in batches of any size."""
    rng = random.Random(seed)
    changes = list(changes)
    rng.shuffle(changes)
    ends = sorted(rng.randrange(len(changes) + 1) for _ in range(parts - 1))
    return [changes[a:b] for a, b in zip([0, *ends], [*ends, len(changes)])]


@pytest.mark.parametrize("mode, loaded", [(IGNORE, 1), (BAG, 3)])
@pytest.mark.parametrize("seed, folds", [(1, ()), (2, (0, 1, 2, 3)), (3, (1,))])
def test_batches_of_two_writers_in_any_order(spark, tmp_path, mode, loaded, seed, folds):
    target, changes = random_case(seed, keys=25, loaded=loaded)
    log = table(spark, tmp_path / "t", mode, target)
    twice = random.Random(seed).sample(changes, 30)
    for n, batch in enumerate(cut(changes + twice, seed, 4)):
        log.append(spark.createDataFrame(batch, CHANGES), n // 2, "ab"[n % 2])
        if n in folds:
            log.fold()
    assert contents(log) == replay(target, changes, mode == BAG)
    log.fold()
    log.clean()
    assert contents(log) == replay(target, changes, mode == BAG)
    assert sum(r.n_repeated for r in log.notes().collect()) == 30
    assert sum(r.n_changes for r in log.notes().collect()) == len(changes)


def test_two_writers_with_and_without_a_fold_between(spark, tmp_path):
    first = [("INSERT", START, 1, "k", 0.0, "x"), ("UPDATE", START + dt.timedelta(seconds=1), 2, "k", 1.0, "x")]
    second = [("UPDATE", START + dt.timedelta(seconds=2), 3, "k", 2.0, "x")]
    for n, (order, folds) in enumerate(itertools.product(([0, 1], [1, 0]), ([], [0]))):
        log = table(spark, tmp_path / str(n), IGNORE)
        for i in order:
            log.append(spark.createDataFrame((first, second)[i], CHANGES), (100, 0)[i], "ab"[i])
            if i in folds:
                log.fold()
        assert contents(log) == [("k", 2.0, "x")]


def test_batch_numbers_that_begin_anew(spark, tmp_path):
    log = table(spark, tmp_path / "t", BAG)
    for n in (0, 1, 0):
        at = len(contents(log)) + 1
        log.append(spark.createDataFrame([("INSERT", START, at, "k", float(at), "x")], CHANGES), n, "w")
        log.fold()
    assert contents(log) == [("k", 1.0, "x"), ("k", 2.0, "x"), ("k", 3.0, "x")]


@pytest.mark.parametrize("mode", [IGNORE, BAG])
def test_a_late_deletion_shows_the_insert_that_waited(spark, tmp_path, mode):
    at = lambda s: START + dt.timedelta(seconds=s)
    changes = [("INSERT", at(1), 1, "k", 1.0, "x"), ("INSERT", at(5), 5, "k", 5.0, "y"), ("DELETE", at(3), 3, "k", None, None)]
    changes += [("UPDATE", at(2), 2, "k", 9.0, "z"), ("INSERT", at(0), 9, "k", 7.0, "w"), ("DELETE", at(6), 6, "l", None, None)]
    changes += [("INSERT", at(4), 10, "l", 1.0, "gone"), ("UPDATE", at(7), 11, "l", 1.0, "nothing to update")]
    for n, order in enumerate(random.Random(1).sample(list(itertools.permutations(changes)), 2)):
        log = table(spark, tmp_path / str(n), mode)
        for i, change in enumerate(order):
            log.append(spark.createDataFrame([change], CHANGES), i)
            if i % 3 == 0:
                log.fold()
        assert contents(log) == [("k", 5.0, "y")]


def test_an_id_counts_once_whatever_it_says(spark, tmp_path):
    log = table(spark, tmp_path / "t", BAG)
    log.append(spark.createDataFrame([("INSERT", START, 1, "k", 1.0, "x")] * 500, CHANGES))
    assert contents(log) == [("k", 1.0, "x")]
    log.fold()
    log.append(spark.createDataFrame([("INSERT", START, 1, "other", 2.0, "x"), ("DELETE", START, 1, "k", 2.0, "x")], CHANGES))
    log.append(spark.createDataFrame([("INSERT", START, None, "n", 3.0, "x")] * 2, CHANGES))
    assert contents(log) == [("k", 1.0, "x"), ("n", 3.0, "x"), ("n", 3.0, "x")]
    log.fold()
    assert [(r.n_changes, r.n_repeated) for r in log.notes().orderBy("version").collect()] == [(1, 499), (2, 2)]


def test_changes_are_stored_once_their_repeats_are_out(spark):
    some = [("INSERT", START, n % 3, "k", 1.0, "x") for n in range(5)]
    fresh, known = only_new(spark.createDataFrame(some, CHANGES).repartition(2), spark.createDataFrame([], APPLIED))
    assert known.count() == 2 and fresh.count() == 3 and is_stored(fresh)


def test_of_one_id_in_a_batch_the_earliest_counts(spark):
    rows = [("INSERT", START + dt.timedelta(seconds=s), 1, "k", float(s), "x") for s in (5, 3, 4, 3)]
    for some in itertools.permutations(rows):
        fresh, known = only_new(spark.createDataFrame(some, CHANGES).repartition(2), spark.createDataFrame([], APPLIED))
        assert [r.a for r in fresh.collect()] == [3.0] and [tuple(r) for r in known.collect()] == [(1, 4, False)]
        break


@pytest.mark.parametrize("mode, loaded", [(IGNORE, 1), (BAG, 2)])
def test_merging_beyond_the_broadcast_limit(spark, mode, loaded):
    target, changes = random_case(9, keys=15, loaded=loaded, hot=200)
    state = initial_state(spark, spark.createDataFrame([], TARGET).schema, ["k"], spark.createDataFrame(target, TARGET))
    for batch in cut(changes, 5, 3):
        fresh, _ = only_new(spark.createDataFrame(batch, CHANGES), state.applied, SHUFFLED)
        state, _ = merge(state, fresh, ["k"], mode, SHUFFLED)
    got = sorted(map(tuple, shown(state, ["k", "a", "b"]).collect()), key=repr)
    assert got == replay(target, changes, mode == BAG)


@pytest.mark.parametrize("seed", range(3))
def test_ranges(spark, seed):
    rng = random.Random(seed)
    ids = [rng.randrange(-200, 200) for _ in range(150)] + [2**62, 2**62 + 1, 2**16 - 1, 2**16]
    applied = spark.createDataFrame([], APPLIED)
    for part in (ids[:40], ids[40:]):
        applied = ranges_of(applied, spark.createDataFrame([(i,) for i in part], "audit_id long"))
    found = [range(r.low, r.high + 1) for r in applied.collect()]
    assert sorted(i for r in found for i in r) == sorted(set(ids))
    runs = sum(1 for i in set(ids) if i - 1 not in set(ids) or i % 2**16 == 0)
    assert len(found) == runs
    asked = spark.createDataFrame([(i, 1 + i % 2) for i in range(-220, 220)], "audit_id long, n long")
    known = {r.audit_id: (r.n, r.before) for r in known_ids(asked, applied).collect()}
    assert known == {i: (1 + i % 2, i in set(ids)) for i in range(-220, 220) if i in set(ids) or i % 2}


@pytest.mark.parametrize("mode", [IGNORE, BAG])
def test_settled_time_drops_what_only_older_changes_need(spark, tmp_path, mode):
    target, changes = random_case(13, keys=30, loaded=1)
    edge = START + dt.timedelta(seconds=3)
    old, new = [c for c in changes if c[1] < edge], [c for c in changes if c[1] >= edge]
    log = table(spark, tmp_path / "t", mode, target)
    log.append(spark.createDataFrame(old, CHANGES))
    log.fold(settled=f"{edge.isoformat()}+00:00")
    state = log._state(log._noted())
    assert state.marks.count() == 0 and state.rows.where("not _shown").count() == 0
    late = [("DELETE", START, 10**6 + n, f"k{n}", None, None) for n in range(30)]
    for batch in cut(new + late, 3, 2):
        log.append(spark.createDataFrame(batch, CHANGES))
        log.fold()
    assert contents(log) == replay(target, changes, mode == BAG)
    assert sum(r.n_late for r in log.notes().collect()) == 30
    log.fold(settled="2000-01-01T00:00:00+00:00")  # the time never goes back
    assert log._noted().settled_until == edge or str(log._noted().settled_until).startswith(str(edge)[:10])


def test_clean_leaves_what_the_last_two_notes_need(spark, tmp_path):
    log = table(spark, tmp_path / "t", BAG)
    for n in range(4):
        log.append(spark.createDataFrame([("INSERT", START, n, "k", float(n), "x")], CHANGES), n)
        log.fold()
        log.clean()
    assert len(list((tmp_path / "t" / "log").glob("part=*"))) == 1
    assert sorted(p.name for p in (tmp_path / "t" / "state").iterdir()) == ["version=3", "version=4"]
    assert len(contents(log)) == 4 and log._noted().parts and not log.fold()


def test_a_part_that_was_not_finished_is_not_read(spark, tmp_path):
    log = table(spark, tmp_path / "t", BAG)
    log.append(spark.createDataFrame([("INSERT", START, 1, "k", 1.0, "x")], CHANGES), 7)
    for part in (tmp_path / "t" / "log").glob("part=*"):
        (part / "_SUCCESS").rename(part / "_HELD")
    assert contents(log) == [] and not log.fold()


def test_loading_several_rows_of_a_key(spark, tmp_path):
    rows = [("k", 1.0, "x"), ("k", 2.0, "x"), (None, 1.0, "x"), (None, 1.0, "x")]
    with pytest.raises(ValueError, match="several rows"):
        table(spark, tmp_path / "a", IGNORE, rows)
    assert len(contents(table(spark, tmp_path / "b", BAG, rows))) == 4
    log = table(spark, tmp_path / "c", IGNORE, rows[1:])
    log.append(spark.createDataFrame([("DELETE", START, 1, None, None, None), ("INSERT", START, 2, "k", 9.0, "y")], CHANGES))
    assert contents(log) == sorted(rows[1:], key=repr)


def test_rows_no_change_concerns_are_not_moved(spark, tmp_path):
    target, changes = random_case(6, loaded=1)
    log = table(spark, tmp_path / "t", BAG, target)
    state = log._state(log._noted())
    after, _ = merge(state, spark.createDataFrame(changes, CHANGES), ["k"], BAG)
    text = after.rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in text and "BroadcastHashJoin" in text


def test_marks_layout(spark):
    schema = spark.createDataFrame([], TARGET).schema
    assert marks_layout(schema, ["k"]).simpleString() == (
        "struct<k:string,_deleted:decimal(38,0),_updated:decimal(38,0),_new:struct<a:double,b:string>>"
    )
    assert settle_until(initial_state(spark, schema, ["k"]), F.lit(START)).rows.count() == 0

import pytest

from tallystream.operators.fold import BAG, IGNORE, apply_changes
from tallystream.operators.joins import JoinLimits
from tests.replay import CHANGES, TARGET, in_order, random_case, replay

SHUFFLED = JoinLimits(broadcast_bytes=-1)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def run(spark, target, changes, mode, limits=None):
    args = [limits] if limits else []
    return apply_changes(
        spark.createDataFrame(target, TARGET), spark.createDataFrame(changes, CHANGES), ["k"], mode, *args
    )


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("mode, loaded", [(IGNORE, 1), (BAG, 3)])
def test_fold_equals_replay(spark, seed, mode, loaded):
    target, changes = random_case(seed, loaded=loaded)
    assert rows_of(run(spark, target, changes, mode)) == replay(target, changes, mode == BAG)


@pytest.mark.parametrize("mode, loaded", [(IGNORE, 1), (BAG, 3)])
def test_hot_key_beyond_the_broadcast_limit(spark, mode, loaded):
    target, changes = random_case(9, loaded=loaded, hot=400)
    assert rows_of(run(spark, target, changes, mode, SHUFFLED)) == replay(target, changes, mode == BAG)


@pytest.mark.parametrize("mode, loaded", [(IGNORE, 1), (BAG, 3)])
def test_result_does_not_depend_on_batch_cuts(spark, mode, loaded):
    target, changes = random_case(4, keys=20, loaded=loaded)
    ordered = in_order(changes)
    state = spark.createDataFrame(target, TARGET)
    for part in (ordered[:13], ordered[13:14], ordered[14:60], ordered[60:]):
        state = apply_changes(state, spark.createDataFrame(part, CHANGES), ["k"], mode)
    assert rows_of(state) == replay(target, changes, mode == BAG)


def test_no_changes_leaves_the_target(spark):
    target, _ = random_case(5, loaded=1)
    assert rows_of(run(spark, target, [], IGNORE)) == sorted(target, key=repr)


def test_update_to_null_is_an_update(spark):
    from tests.replay import START

    changes = [("UPDATE", START, 1, "k", None, None)]
    assert rows_of(run(spark, [("k", 1.0, "x")], changes, IGNORE)) == [("k", None, None)]


def test_changes_are_combined_before_the_shuffle(spark):
    from tallystream.operators.fold import last_marks

    changes = spark.createDataFrame(random_case(1)[1], CHANGES)
    plan = last_marks(changes, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_max" in plan and "Window" not in plan
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_the_target_is_not_shuffled(spark, tmp_path):
    target, changes = random_case(6, loaded=1)
    spark.createDataFrame(target, TARGET).write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    for mode in (IGNORE, BAG):
        plan = apply_changes(stored, spark.createDataFrame(changes, CHANGES), ["k"], mode)
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in text and "BroadcastHashJoin" in text


def test_a_change_delivered_twice_counts_once(spark):
    target, changes = random_case(12, loaded=1)
    assert rows_of(run(spark, target, changes + changes, IGNORE)) == replay(target, changes, False)

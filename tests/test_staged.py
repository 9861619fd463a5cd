"""The table that takes each batch once, all of it or nothing."""

import threading

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallystream.operators.fold import BAG, apply_changes
from tallystream.schemas import AUDIT, YEAR
from tallystream.sources.staged import StagedTable, _Table, committed
from tests.test_sources import audit

ROWS = "id long, v string"


@pytest.fixture
def table(spark, tmp_path):
    spark.dataSource.register(StagedTable)
    return str(tmp_path / "table")


def write(df, path, epoch, stream="load"):
    df.write.format("staged_table").mode("append").option("stream", stream).option("epoch", epoch).save(path)


def rows(spark, path, schema=ROWS):
    kind = spark.createDataFrame([], schema).schema if isinstance(schema, str) else schema
    return sorted(map(tuple, committed(spark, path, kind).collect()))


def files(tmp_path):
    return len(list((tmp_path / "table" / "files").glob("*.parquet")))


def test_a_repeated_batch_counts_once(spark, table, tmp_path):
    one = spark.createDataFrame([(i, str(i)) for i in range(10)], ROWS).repartition(3)
    assert rows(spark, table) == []
    for _ in range(2):
        write(one, table, 0)
    assert rows(spark, table) == [(i, str(i)) for i in range(10)] and files(tmp_path) == 3
    write(one, table, 1)
    write(one.limit(0), table, 2)
    write(one.limit(1), table, 0, "other")
    assert len(rows(spark, table)) == 21
    chosen = spark.createDataFrame([("load", 1), ("other", 0)], "stream string, epoch long")
    assert committed(spark, table, one.schema, chosen).count() == 11


def test_a_failed_task_leaves_nothing(spark, table, tmp_path):
    good = spark.range(100).select("id", F.col("id").cast("string").alias("v"))
    write(good, table, 0)
    held = files(tmp_path)
    bad = good.repartition(4).withColumn("v", F.when(F.col("id") == 77, F.raise_error(F.lit("lost"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        write(bad, table, 1)
    assert len(rows(spark, table)) == 100 and files(tmp_path) == held
    write(good, table, 1)
    assert len(rows(spark, table)) == 200


def test_files_of_tasks_that_end_after_the_batch_failed_go(table, tmp_path):
    batch = _Table(table, "load")
    batch.stage(iter([pa.record_batch({"id": [1]})]))
    late = threading.Timer(0.5, lambda: batch.stage(iter([pa.record_batch({"id": [2]})])))
    late.start()
    batch.abort()
    late.join()
    assert files(tmp_path) == 0
    batch.remove({"gone.parquet"})


def test_only_numbered_appends(spark, table):
    df = spark.createDataFrame([(1, "x")], ROWS)
    with pytest.raises(Exception, match="epoch"):
        df.write.format("staged_table").mode("append").save(table)
    with pytest.raises(Exception, match="append"):
        df.write.format("staged_table").mode("overwrite").option("epoch", 1).save(table)


def test_a_stream_that_repeats_its_last_batch(spark, table, tmp_path):
    src = str(tmp_path / "src")

    def run(checkpoint):
        stream = spark.readStream.schema(AUDIT).parquet(src)
        query = stream.writeStream.format("staged_table").option("stream", "audit").option("checkpointLocation", checkpoint)
        query.trigger(availableNow=True).start(table).awaitTermination()
        return [r[0] for r in rows(spark, table, AUDIT)]

    audit(spark, [(1, 1, "INSERT", "Mar 1", 1.0), (2, 2, "INSERT", "Mar 2", 2.0)]).write.parquet(src)
    assert run(str(tmp_path / "a")) == [1, 2]
    # The commit of the checkpoint was lost: the batch is run again.
    for file in (tmp_path / "a" / "commits").iterdir():
        if "0" in file.name:
            file.rename(tmp_path / file.name)
    audit(spark, [(3, 3, "UPDATE", "Mar 1", 3.0)]).write.mode("append").parquet(src)
    assert run(str(tmp_path / "a")) == [1, 2, 3]
    changes = committed(spark, table, AUDIT)
    target = changes.select(*[c for c in AUDIT.names if c not in ("operation_type", "changed_at", "audit_id")]).limit(0)
    state = apply_changes(target, changes, [YEAR], BAG).collect()
    assert sorted((r[YEAR], r.Interest) for r in state) == [("Mar 1", 3.0), ("Mar 2", 2.0)]

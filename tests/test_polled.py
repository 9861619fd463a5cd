"""The polled table as a stream."""

import pytest

from tallystream.functions.messages import decode
from tallystream.sources.polled import PolledAudit, PolledReader
from tallystream.streaming import jobs as J
from tests.test_sources import audit


@pytest.fixture(params=["TIMESTAMP_MICROS", "INT96"])
def polled(spark, tmp_path, request):
    spark.dataSource.register(PolledAudit)
    spark.conf.set("spark.sql.parquet.outputTimestampType", request.param)
    path, out = str(tmp_path / "audit"), str(tmp_path / "out")

    def add(*rows):
        audit(spark, rows).repartition(2).write.mode("append").parquet(path)

    def poll():
        stream = spark.readStream.format("polled_audit").option("split_rows", 2).load(path)
        J.publish_stream(stream, str(tmp_path / "checkpoint"), "parquet", J.AVAILABLE_NOW, path=out).awaitTermination()
        return sorted((r.audit_id, r.Interest) for r in decode(spark.read.parquet(out)).collect())

    yield path, add, poll
    spark.conf.unset("spark.sql.parquet.outputTimestampType")


def test_polls_lose_and_repeat_nothing(spark, polled):
    path, add, poll = polled
    add((1, 1, "INSERT", "Mar 1", 1.0), (2, 1, "UPDATE", "Mar 1", None), (3, None, "INSERT", "Mar 1", 3.0))
    assert poll() == [(1, 1.0), (2, None)]
    assert poll() == [(1, 1.0), (2, None)]
    # A later row of the same time is not lost; one with a cursor that was passed is not read.
    add((4, 1, "INSERT", "Mar 2", 4.0), (5, 9, "INSERT", "Mar 3", 5.0), (0, 0, "INSERT", "Mar 0", 0.0))
    assert poll() == [(1, 1.0), (2, None), (4, 4.0), (5, 5.0)]
    add(*[(10 + i, 20 + i, "INSERT", f"Mar {i}", 1.0) for i in range(30)])
    assert len(poll()) == 34


def test_a_range_is_read_by_several_tasks(spark, polled):
    path, add, _ = polled
    add(*[(i, i, "INSERT", f"Mar {i}", 1.0) for i in range(50)])
    add(*[(i, i, "INSERT", f"Mar {i}", 1.0) for i in range(50, 100)])
    reader = PolledReader(path, 10)
    start, end = reader.initialOffset(), reader.latestOffset()
    assert end["id"] == 99 and len(reader.partitions(start, end)) == 4 and reader.partitions(end, end) == []
    rows = [r for p in reader.partitions(start, end) for batch in reader.read(p) for r in batch.column(0).to_pylist()]
    assert sorted(rows) == list(range(100))
    early = {"at": end["at"] - 90_000_000, "id": 9}
    some = [r for p in reader.partitions(start, early) for batch in reader.read(p) for r in batch.column(0).to_pylist()]
    assert sorted(some) == list(range(10))


def test_no_table_yet(tmp_path):
    reader = PolledReader(str(tmp_path / "none"), 10)
    assert reader.latestOffset() == reader.initialOffset()

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallystream.functions.messages import decode, encode
from tallystream.schemas import AUDIT, COMPANY, METRICS, SINK_MULTI, SINK_SINGLE, YEAR
from tallystream.sources.change_log import ChangeLog
from tallystream.streaming import jobs as J
from tests.replay import in_order, random_case, replay
from tests.test_sources import audit

RECORD = "key binary, value binary"


def messages(spark, changes, company):
    """Random changes as records; the value is in every metric, the text in none."""
    rows = [
        (i, op, at.replace(tzinfo=dt.timezone.utc), "u", k, *[a] * len(METRICS), "A") for op, at, i, k, a, _ in changes
    ]
    return encode(spark.createDataFrame(rows, AUDIT), company)


def source(spark, path, per_batch=1):
    return spark.readStream.schema(RECORD).option("maxFilesPerTrigger", per_batch).parquet(path)


def test_publish_and_resume(spark, tmp_path):
    src, out, mark = (str(tmp_path / n) for n in ("audit", "out", "checkpoint"))

    def run():
        stream = spark.readStream.schema(AUDIT).parquet(src)
        J.publish_stream(stream, mark, "parquet", J.AVAILABLE_NOW, path=out).awaitTermination()
        return sorted(r.audit_id for r in decode(spark.read.parquet(out)).collect())

    audit(spark, [(1, 1, "INSERT", "Mar 1", 1.0)]).write.parquet(src)
    assert run() == [1]
    audit(spark, [(2, 2, "UPDATE", "Mar 1", 2.0)]).write.mode("append").parquet(src)
    assert run() == [1, 2]
    assert run() == [1, 2]


def test_apply_in_several_batches_equals_replay(spark, tmp_path):
    _, changes = random_case(11, keys=12, loaded=0)
    ordered = in_order(changes)
    src = str(tmp_path / "records")
    table = ChangeLog(spark, str(tmp_path / "table"), SINK_SINGLE, [YEAR])
    cut = len(ordered) // 2
    for part in (ordered[:cut], ordered[cut:]):
        messages(spark, part, company=False).coalesce(1).write.mode("append").parquet(src)
        J.apply_stream(
            source(spark, src), table, str(tmp_path / "checkpoint"), J.AVAILABLE_NOW, company=False
        ).awaitTermination()
    plain = [(op, at, i, k, a) for op, at, i, k, a, _ in changes]
    want = replay([], plain, bag=False)
    got = sorted(((r[YEAR], r.Interest) for r in table.read().collect()), key=repr)
    assert got == want


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    table = ChangeLog(spark, str(tmp_path / "table"), SINK_SINGLE, [YEAR])
    records = encode(audit(spark, [(1, 1, "UPDATE", "Mar 1", 2.0), (2, 2, "INSERT", "Mar 1", 1.0)]), company=False)
    for _ in range(2):
        J.apply_records(table, records, 0, "stream", company=False)
    assert [r.Interest for r in table.read().collect()] == [1.0]


@pytest.mark.parametrize("skip, held", [(None, {"Mar 1"}), ([], {"Mar 1", "TTM"})])
def test_multi_company_apply(spark, tmp_path, skip, held):
    rows = [
        (1, 1, "INSERT", "Mar 1", 1200.0),
        (2, 2, "INSERT", "TTM", 5.0),
        (3, 3, "MERGE", "Mar 2", 5.0),
        (4, 4, "INSERT", "Mar 3", 0.0),
        (5, 5, "INSERT", "Mar 4", None),
    ]
    src, bad = str(tmp_path / "records"), str(tmp_path / "rejects")
    encode(audit(spark, rows)).coalesce(1).write.parquet(src)
    table = ChangeLog(spark, str(tmp_path / "table"), SINK_MULTI, [YEAR, COMPANY], "bag")
    J.apply_stream(
        source(spark, src), table, str(tmp_path / "checkpoint"), J.AVAILABLE_NOW, skip_periods=skip, rejects_path=bad
    ).awaitTermination()
    out = table.read().collect()
    assert {r[YEAR] for r in out} == held
    row = [r for r in out if r[YEAR] == "Mar 1"][0]
    assert (row.total_profit, row.net_profit_margin, row.profit_category) == (2400.0, 100.0, "Medium")
    reasons = spark.read.parquet(bad).select("key", "reason").orderBy("key").collect()
    assert [tuple(r) for r in reasons] == [("3", "unknown_operation"), ("4", "zero_sales"), ("5", "null_metric")]
    assert spark.read.parquet(bad).where(F.col("raw").isNull()).count() == 0

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallystream.functions.messages import decode
from tallystream.schemas import AUDIT, COMPANY, METRICS, SINK_MULTI, SINK_SINGLE, YEAR
from tallystream.sources import tables as R
from tallystream.sources.change_log import ChangeLog
from tests.replay import replay

START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def audit(spark, rows):
    """Rows of (audit id, seconds, operation, year, value)."""
    full = [
        (i, op, None if s is None else START + dt.timedelta(seconds=s), "u", year, *[v] * len(METRICS), "A")
        for i, s, op, year, v in rows
    ]
    return spark.createDataFrame(full, AUDIT)


def test_marks(spark, tmp_path):
    path = str(tmp_path / "mark")
    assert R.read_high_water(spark, path) == (None, None)
    R.store_high_water(spark, path, "2024-01-02T00:00:00.000001+00:00", 7)
    R.store_high_water(spark, path, "2024-01-01T00:00:00.000000+00:00", 9)
    assert R.read_high_water(spark, path) == ("2024-01-02T00:00:00.000001+00:00", 7)
    for n in range(6):
        R.store_high_water(spark, path, f"2024-02-0{n + 1}T00:00:00.000000+00:00", n)
        assert R.read_high_water(spark, path) == (f"2024-02-0{n + 1}T00:00:00.000000+00:00", n)
    assert spark.read.text(path).count() == 2


@pytest.mark.parametrize(
    "text, mark",
    [
        ("2024-09-02T13:44:54.668705+00:00", "2024-09-02T13:44:54.668705+00:00"),
        ("2024-09-02T13:44:54.668705", "2024-09-02T13:44:54.668705+00:00"),
        ("", None),
        ("garbage", None),
        ("0001-01-01T00:00:00", None),
    ],
)
def test_mark_files_with_just_a_time(spark, tmp_path, text, mark):
    (tmp_path / "mark.txt").write_text(text)
    assert R.read_high_water(spark, str(tmp_path / "mark.txt")) == (mark, None)


def test_publish_increment(spark, tmp_path):
    mark, out = str(tmp_path / "mark"), str(tmp_path / "out")
    rows = [(1, 0, "INSERT", "Mar 1", 1.0), (2, 5, "UPDATE", "Mar 1", 2.0), (9, None, "DELETE", "Mar 1", None)]

    def publish(rows):
        return R.publish_increment(audit(spark, rows), mark, "parquet", path=out)

    def published():
        return sorted(r.audit_id for r in decode(spark.read.parquet(out)).collect())

    # The first run has no mark; a record without a time is never newer than anything.
    assert publish(rows) and published() == [1, 2]
    assert not publish(rows) and published() == [1, 2]
    # A later record with the time of the mark is not lost.
    assert publish([*rows, (3, 5, "UPDATE", "Mar 1", 3.0)]) and published() == [1, 2, 3]


def test_companies(spark, tmp_path):
    rows = [("Smith, Sons & \"Co\"", "Health", "M&M", "EQ", "X1"), ("Plain Ltd.", "Oil", "BAJ-A", "EQ", "X2")]
    df = spark.createDataFrame(rows, ["Company Name", "Industry", "Symbol", "Series", "ISIN Code"])
    R.write_companies(df, str(tmp_path / "c"))
    assert sorted(map(tuple, R.read_companies(spark, str(tmp_path / "c")).collect())) == sorted(rows)


def test_replace_and_append(spark, tmp_path):
    path = str(tmp_path / "t")
    for write, want in ((R.replace_table, 3), (R.append_table, 6), (R.replace_table, 3)):
        write(spark.range(3), path)
        assert spark.read.parquet(path).count() == want


def keyed(spark, tmp_path, mode="ignore", schema=SINK_SINGLE, keys=(YEAR,)):
    return ChangeLog(spark, str(tmp_path / "table"), schema, list(keys), mode)


def years(df, *extra):
    return sorted((tuple(r[c] for c in (YEAR, *extra, "Interest")) for r in df.collect()), key=repr)


def log_rows(table):
    return table.spark.read.parquet(f"{table.root}/log").count()


def test_change_log(spark, tmp_path):
    table = keyed(spark, tmp_path)
    assert table.read().count() == 0 and set(table.average().first()[1:]) == {None} and not table.fold()
    first = [(1, 1, "INSERT", "Mar 1", 10.0), (2, 2, "INSERT", "Mar 2", 50.0), (3, 3, "INSERT", "TTM", 7.0)]
    table.append(audit(spark, first), 0)
    second = [(4, 4, "INSERT", "Mar 1", 99.0), (5, 5, "UPDATE", "Mar 2", 20.0), (6, 6, "INSERT", "Mar 3", None)]
    table.append(audit(spark, second), 1)
    held = [("Mar 1", 10.0), ("Mar 2", 20.0), ("Mar 3", None), ("TTM", 7.0)]
    assert years(table.read()) == held
    assert years(table.read_with_average()) == [("AVERAGE", 15.0), *held]
    assert table.fold() and not table.fold()
    assert years(table.read()) == held
    table.append(audit(spark, [(7, 7, "DELETE", "Mar 1", None), (8, 8, "DELETE", "Mar 2", None)]), 2)
    table.append(audit(spark, []), 3)
    assert years(table.read_with_average()) == [("AVERAGE", None), ("Mar 3", None), ("TTM", 7.0)]
    assert table.fold() and years(table.read()) == [("Mar 3", None), ("TTM", 7.0)]
    with pytest.raises(ValueError):
        table.load_initial(audit(spark, first).select(*SINK_SINGLE.names))


def test_a_batch_writes_its_own_rows_only(spark, tmp_path):
    table = keyed(spark, tmp_path)
    table.load_initial(audit(spark, [(i, i, "INSERT", f"Mar {i}", float(i)) for i in range(3000)]).select(*SINK_SINGLE.names))
    table.append(audit(spark, [(i, i, "UPDATE", f"Mar {i * 7}", -1.0) for i in range(200)]), 0)
    assert log_rows(table) == 200
    assert table.read().where("Interest = -1").count() == 200 and table.read().count() == 3000


@pytest.mark.parametrize("partitions", [1, 7])
def test_parallelism_does_not_matter(spark, tmp_path, partitions):
    table = keyed(spark, tmp_path)
    table.append(audit(spark, [(i, i, "INSERT", f"Mar {i}", 0.0) for i in range(50)]).repartition(partitions), 0)
    table.fold()
    spark.conf.set("spark.sql.shuffle.partitions", str(9 - partitions))
    try:
        table.append(audit(spark, [(100 + i, i, "UPDATE", f"Mar {i}", 1.0) for i in range(50)]).repartition(5), 1)
        assert years(table.read()) == sorted((f"Mar {i}", 1.0) for i in range(50))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_batches_replayed_in_turn_by_several_writers(spark, tmp_path):
    table = keyed(spark, tmp_path, "bag")
    many = audit(spark, [(i, i, "INSERT", f"Mar {i}", 1.0) for i in range(50)])
    table.append(many, 0, "a/1")
    table.append(audit(spark, [(99, 99, "INSERT", "Mar 99", 1.0)]), 0, "b")
    table.append(many, 0, "a/1")
    assert table.read().count() == 51
    table.fold()
    table.append(many, 0, "a/1")  # a replay after the fold
    assert table.read().count() == 51
    table.append(many, 1, "a/1")  # republished
    assert table.read().count() == 51


def test_changes_apply_in_order_of_time_whatever_their_batches(spark, tmp_path):
    table = keyed(spark, tmp_path)
    table.append(audit(spark, [(1, 50, "INSERT", "Mar 1", 1.0), (2, 60, "UPDATE", "Mar 1", 2.0)]), 0)
    table.append(audit(spark, [(9, 55, "UPDATE", "Mar 1", 3.0), (8, 4, "UPDATE", "Mar 1", 4.0)]), 1)
    assert years(table.read()) == [("Mar 1", 2.0)]


def test_a_fold_that_stopped_is_not_seen(spark, tmp_path):
    table = keyed(spark, tmp_path)
    table.append(audit(spark, [(1, 1, "INSERT", "Mar 1", 10.0)]), 0)
    # What a fold that died before its note leaves behind.
    table.read().limit(0).write.parquet(f"{table.root}/state/version=1/rows")
    assert years(table.read()) == [("Mar 1", 10.0)]
    assert table.fold() and years(table.read()) == [("Mar 1", 10.0)]


def test_bag_table_with_company(spark, tmp_path):
    table = keyed(spark, tmp_path, "bag", SINK_MULTI, (YEAR, COMPANY))
    rows = [(1, 1, "INSERT", "Mar 1", 1.0), (2, 2, "INSERT", "Mar 1", 2.0), (3, 3, "INSERT", "Mar 2", 3.0)]
    more = [(4, 4, "UPDATE", "Mar 1", 4.0), (5, 5, "INSERT", "Mar 1", 5.0), (6, 6, "DELETE", "Mar 2", None)]
    for batch, part in enumerate((rows, more)):
        full = audit(spark, part).withColumns(
            {"total_profit": F.lit(0.0), "net_profit_margin": F.lit(0.0), "profit_category": F.lit("Low")}
        )
        table.append(full, batch)
    assert years(table.read()) == [("Mar 1", 4.0), ("Mar 1", 4.0), ("Mar 1", 5.0)]
    plain = [(op, s, i, y, v) for i, s, op, y, v in rows + more]
    assert replay([], plain, bag=True) == years(table.read())

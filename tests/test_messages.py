import datetime as dt
import json

import pytest

from tallystream.functions import messages as M
from tallystream.functions.derive import derive_profit
from tallystream.schemas import AUDIT, COMPANY, DERIVED, METRICS, SINK_MULTI, YEAR

AT = dt.datetime(2024, 9, 2, 13, 44, 54, 668705, tzinfo=dt.timezone.utc)


def audit(spark, **changes):
    row = {"audit_id": 5, "operation_type": "INSERT", "changed_at": AT, "changed_by": "u", YEAR: "Mar 2020", COMPANY: "A"}
    row.update({m: float(i) for i, m in enumerate(METRICS, start=1)})
    row.update(changes)
    return spark.createDataFrame([tuple(row[n] for n in AUDIT.names)], AUDIT)


def test_encode(spark):
    row = M.encode(audit(spark, Interest=None)).first()
    assert bytes(row.key) == b"5"
    body = json.loads(bytes(row.value))
    assert list(body) == ["operation_type", "changed_at", YEAR, *METRICS, COMPANY]
    assert body["changed_at"] == "2024-09-02T13:44:54.668705+00:00"
    assert body["Interest"] is None and body["Sales_plus"] == 1.0
    assert COMPANY not in json.loads(bytes(M.encode(audit(spark), company=False).first().value))


def test_changes_of_a_key_share_a_partition(spark):
    df = audit(spark).unionByName(audit(spark, audit_id=6)).unionByName(audit(spark, Company_id="B"))
    parts = [r.partition for r in M.encode(df, partitions=1000).collect()]
    assert parts[0] == parts[1] != parts[2] and all(0 <= p < 1000 for p in parts)


def test_round_trip(spark):
    for company in (True, False):
        source = audit(spark, Interest=None, Sales_plus=12.34)
        back = M.decode(M.encode(source, company), company)
        fields = ["audit_id", "operation_type", "changed_at", YEAR, *METRICS] + ([COMPANY] if company else [])
        assert back.select(*fields).first() == source.select(*fields).first()


def record(spark, value, key=b"1"):
    return spark.createDataFrame([(bytearray(key), None if value is None else bytearray(value))], "key binary, value binary")


def reason(spark, value, company=True):
    return M.triage(M.decode(record(spark, value), company), company).first().reason


@pytest.mark.parametrize(
    "changes, multi, single",
    [
        ({}, None, None),
        ({"operation_type": "MERGE"}, "unknown_operation", "unknown_operation"),
        ({"operation_type": None}, "unknown_operation", "unknown_operation"),
        ({YEAR: None}, "null_key", "null_key"),
        ({COMPANY: None}, "null_key", None),
        ({YEAR: "AVERAGE"}, "reserved_key", "reserved_key"),
        ({"Sales_plus": 0.0}, "zero_sales", None),
        ({"EPS_in_Rs": None}, "null_metric", None),
        ({"Interest": None}, None, None),
        ({"EPS_in_Rs": None, "operation_type": "DELETE"}, None, None),
    ],
)
def test_triage(spark, changes, multi, single):
    for company, want in ((True, multi), (False, single)):
        records = M.encode(audit(spark, **changes), company)
        triaged = M.triage(M.decode(records, company), company)
        assert triaged.first().reason == want
        assert M.accepted(triaged).count() == (want is None)
        assert M.rejects(triaged).count() == (want is not None)


def test_unreadable_records(spark):
    assert reason(spark, b'{"operation_type": ') == "malformed_json"
    assert reason(spark, b"") in ("malformed_json", "unknown_operation")
    assert reason(spark, None) == "unknown_operation"
    assert reason(spark, b"{}") == "unknown_operation"
    bad = M.rejects(M.triage(M.decode(record(spark, b"{nonsense"))))
    assert tuple(bad.first()) == ("messages", "1", "malformed_json", "{nonsense")


@pytest.mark.parametrize("company", [True, False])
def test_damaged_fields_are_rejected(spark, company):
    good = json.loads(bytes(M.encode(audit(spark), company).first().value))

    def why(key=b"1", **changes):
        value = json.dumps({**good, **changes}).encode()
        return M.triage(M.decode(record(spark, value, key), company), company).first().reason

    assert why() is None
    assert why(changed_at="garbage") == "malformed_field"
    assert why(Interest="abc") == "malformed_field"
    assert why(changed_at=None) == "null_time"
    assert why(key=b"x7") == "null_audit_id" and why(key=b"") == "null_audit_id"
    bad = M.rejects(M.triage(M.decode(record(spark, json.dumps(good).encode(), b"x7"), company), company)).first()
    assert (bad.key, bad.reason) == ("x7", "null_audit_id")


def test_text_is_parsed_once(spark):
    plan = M.accepted(M.triage(M.decode(M.encode(audit(spark)))))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


@pytest.mark.parametrize(
    "net, category",
    [(999.99, "Low"), (1000.0, "High"), (1000.01, "Medium"), (4999.99, "Medium"), (5000.0, "High"), (None, None)],
)
def test_profit_category(spark, net, category):
    assert derive_profit(audit(spark, Net_Profit_plus=net)).first().profit_category == category


def test_derived_columns(spark):
    row = derive_profit(
        audit(spark, Sales_plus=300.0, Net_Profit_plus=100.0, Operating_Profit=2.0, Other_Income_plus=3.5, EPS_in_Rs=2.675)
    ).first()
    assert [row[c] for c in DERIVED] == [5.5, 33.33, "Low"]
    assert row.EPS_in_Rs == 2.68
    assert derive_profit(audit(spark, Sales_plus=0.0)).first().net_profit_margin is None
    assert set(SINK_MULTI.names) <= set(derive_profit(audit(spark)).columns)

import datetime as dt

from tidemark.operators.quality import split_rejects
from tidemark.operators.shape import project_explicit, wrap_payload
from tidemark.specs import ORDER_EVENTS as OE


def test_project_explicit_rules(spark):
    recs = spark.createDataFrame([
        ('{"zzz": 1}',),
        ('{"record_id": "r1", "status": 5, "channel": true, "category": {"k": 1}, '
         '"order_ref": "", "region_code": null, "event_timestamp": "2024-01-01T10:00:00+02:00"}',),
        ('{"record_id": "r2", "event_timestamp": 20240101, "order_date": "2024-02-30"}',),
    ], "record_json string")
    rows = project_explicit(recs, OE).collect()
    assert all(rows[0][c] is None for c in OE.business_columns)          # extra keys dropped
    r1 = rows[1]
    assert (r1["status"], r1["channel"], r1["category"]) == ("5", "true", '{"k":1}')
    assert r1["order_ref"] is None and r1["region_code"] is None        # '' and null → NULL
    assert r1["event_timestamp"] == dt.datetime(2024, 1, 1, 8, 0)        # offset → UTC
    assert rows[2]["event_timestamp"] is None                            # JSON number → NULL
    good, bad = split_rejects(project_explicit(recs, OE), OE)
    assert good.count() == 2
    assert bad.collect()[0]["error"] == "invalid DATE for order_date: '2024-02-30'"


def test_wrap_payload_is_canonical(spark):
    recs = spark.createDataFrame(
        [('{"b": 2.0, "a": {"y": 1, "x": [1, 2]}}', dt.datetime(2024, 1, 5, 23, 0))],
        "record_json string, modificationTime timestamp")
    r = wrap_payload(recs).collect()[0]
    assert r["payload"] == '{"a":{"x":[1,2],"y":1},"b":2}'
    assert r["_partition_date"] == dt.date(2024, 1, 5)

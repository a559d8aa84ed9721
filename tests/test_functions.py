import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import canonical_json, folder_of, json_value, safe_timestamp

# FIXTURES.md §3 truth table (expected UTC wall clock, None = NULL)
TRUTH = [
    ("2024-01-01T10:00:00Z", dt.datetime(2024, 1, 1, 10)),
    ("2024-01-01T10:00:00", dt.datetime(2024, 1, 1, 10)),
    ("2024-01-01", dt.datetime(2024, 1, 1)),
    ("2024-01-01T10:00:00+05:30", dt.datetime(2024, 1, 1, 4, 30)),
    ("2024-01-01 10:00:00.1234567", dt.datetime(2024, 1, 1, 10, 0, 0, 123456)),
    ("20240101T100000", dt.datetime(2024, 1, 1, 10)),
    ("2024-01-01T10:00:00.5-08:00", dt.datetime(2024, 1, 1, 18, 0, 0, 500000)),
    ("2024-01-01T10", dt.datetime(2024, 1, 1, 10)),
    ("2024-W01-1", dt.datetime(2024, 1, 1)),
    ("2024W015", dt.datetime(2024, 1, 5)),
    ("2020-W53-7T01:02", dt.datetime(2021, 1, 3, 1, 2)),
    ("2021-W53-1", None),
    ("2024-W00-1", None),
    ("2024-01-01T10:00:00+05:30:15", dt.datetime(2024, 1, 1, 4, 29, 45)),
    ("2024-01-01T10:00:00-053015", dt.datetime(2024, 1, 1, 15, 30, 15)),
    ("2024-01-01_10:00:00", dt.datetime(2024, 1, 1, 10)),
    ("2024-01-01\n10:00", dt.datetime(2024, 1, 1, 10)),
    ("2024-01-01T10:00:00\n", None),
    ("2024", None),
    ("2024-01", None),
    ("2024-1-1", None),
    (" 2024-01-01", None),
    ("2024-01-01 ", None),
    ("12:30:00", None),
    ("2024-01-01T10:00:00 UTC", None),
    ("2024-01-01T24:00:00", None),
    ("2024-02-30", None),
    ("junk", None),
    ("", None),
    (None, None),
]


def test_safe_timestamp_truth_table(spark):
    df = spark.createDataFrame([(s,) for s, _ in TRUTH], "s string")
    got = [r["t"] for r in df.select(
        safe_timestamp("s").cast("timestamp_ntz").alias("t")).collect()]
    assert got == [e for _, e in TRUTH]


def test_canonical_json_and_json_value(spark):
    df = spark.createDataFrame(
        [('{"b": 2.0, "a": [1, {"z":1,"y":2}]}',), ('{"k": {"x": 1}}',), ("nope",)], "j string")
    rows = df.select(canonical_json("j").alias("c"), json_value("j", "$.b").alias("b"),
                     json_value("j", "$.k").alias("k")).collect()
    assert rows[0]["c"] == '{"a":[1,{"y":2,"z":1}],"b":2}'
    assert rows[0]["b"] == "2"
    assert rows[1]["k"] is None  # objects are not scalar values
    assert rows[2]["c"] is None


def test_folder_of(spark):
    df = spark.createDataFrame([("Order_Events/x.json.gz",), ("x.json.gz",)], "n string")
    assert [r[0] for r in df.select(folder_of("n")).collect()] == ["Order_Events", "x.json.gz"]


def test_canonical_json_loses_no_digit(spark):
    """Numbers of any size keep their digits; what isn't JSON has no text."""
    wide = "12345678901234567890123456789012345678901"
    cases = {
        '{"b":1,"a":2.0}': '{"a":2,"b":1}', '{"a":NaN}': None, '{"a":%s}' % wide: '{"a":1.%se40}' % wide[1:], '{"a":"%s"}' % wide: '{"a":"%s"}' % wide,
        '{"a":0.%s}' % wide: '{"a":1.%se-1}' % wide[1:], '{"a":%s}' % wide[:38]: '{"a":%s}' % wide[:38], '{"a":1234567890.123456789012345e10}': '{"a":12345678901234567890.12345}',
        '{"a":' * 1100 + "1" + "}" * 1100: None, '{"a":"x\\"%s"}' % wide: '{"a":"x\\"%s"}' % wide,
    }
    df = spark.createDataFrame([(k,) for k in cases], "j string")
    assert {r.j: r.c for r in df.select("j", canonical_json("j").alias("c")).collect()} == cases

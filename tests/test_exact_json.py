"""Canonical numbers (J1, C13) and what rests on them."""

import decimal
import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark import fixtures as fx
from tidemark.functions.jsonfn import canonical_json
from tidemark.operators.decode import decode_blob
from tidemark.operators.dedup import latest_for_spec
from tidemark.operators.merge import merge_insert_only
from tidemark.operators.quality import split_rejects
from tidemark.operators.shape import REFUSED, REFUSED_RECORD, project_explicit, wrap_payload
from tidemark.operators.views import unified_view, with_identity
from tidemark.plans.jobs import shape_folder
from tidemark.specs import LAST_UPDATED, NOTIFICATION_EVENTS as PAY, ORDER_EVENTS as OE


def canon(spark, texts):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k long, t string").repartition(3)
    return [r.c for r in df.select("k", canonical_json("t").alias("c")).orderBy("k").collect()]


def _number(rng):
    whole = rng.choice(["0", str(rng.randint(1, 10 ** rng.choice([1, 5, 17, 30, 45, 60])))])
    after = rng.choice(["", "", ".0", "." + "".join(rng.choice("0059") for _ in range(rng.randint(1, rng.choice([3, 20, 50]))))])
    power = rng.choice(["", "", rng.choice("eE") + rng.choice(["", "+", "-"]) + str(rng.choice([0, 1, 2, 10, 39, 40, 41, 400, 10**12]))])
    return rng.choice(["", "-"]) + whole + after + power


def test_equal_numbers_have_one_text_and_different_ones_two(spark):
    rng = random.Random(7)
    numbers = [_number(rng) for _ in range(3000)] + ["1e400", "1e-400", "0.1e1", "1.0", "1", "10e-1", "-0", "-0.0", "0e5", "100", "1E2",
                                                     "9007199254740993e0", "9007199254740992e0"]
    texts = canon(spark, numbers)
    values = [_exact(n) for n in numbers]
    by_value, by_text = {}, {}
    for v, t in zip(values, texts):
        assert by_value.setdefault(v, t) == t
        assert by_text.setdefault(t, v) == v
        json.loads(t)
    inside = canon(spark, ['{"z" : %s,"a":[%s, "5e3 x\\" 1E2, 7.0"]}' % (n, n) for n in numbers])
    assert inside == ['{"a":[%s,"5e3 x\\" 1E2, 7.0"],"z":%s}' % (t, t) for t in texts]


def _exact(n):
    with decimal.localcontext() as c:
        c.prec, c.Emax, c.Emin = 200, decimal.MAX_EMAX, decimal.MIN_EMIN
        d = decimal.Decimal(n).normalize()
        return 0 if d.is_zero() else d.as_tuple()


def test_canonical_text_of_odd_texts(spark):
    cases = {
        '{"\\u0001x": 1e2, "a":"\\u00011e2"}': '{"\\u0001x":100,"a":"\\u00011e2"}', '{"\\u0001\\u0001":1e1}': '{"\\u0001\\u0001":10}',
        '{"k":"\\u0001","v":1e1}': '{"k":"\\u0001","v":10}', '"\\u00015"': '"\\u00015"', '"1e2"': '"1e2"', " [ 1e1 , 2 ] ": "[10,2]",
        '{"a":[1e1,{"b":-1.50E-3}],"c":"\\\\"}': '{"a":[10,{"b":-0.0015}],"c":"\\\\"}', '{"1e5":1e5}': '{"1e5":100000}',
        "{1:2e3}": None, '{"a":01e2}': None, "01e2": None, "1.e2": None, '{"a":1e2 1}': None, "[1e2,]": None, '{"a":1e2': None, "1e5\0": None,
        '{"a":1e1,"a":2}': None, "x1e1": None, "": None, None: None, '{"a":1e%s}' % ("9" * 50): None,
        '{"a":"%s","b":1e3}' % ('\\n\\"' * 100_000): '{"a":"%s","b":1000}' % ('\\n\\"' * 100_000),
    }
    assert dict(zip(cases, canon(spark, cases))) == cases


def test_decoder_keeps_exponents_as_written():
    assert decode_blob(__import__("gzip").compress(b'{"a": 1e400, "b": 9007199254740993e0}\n{"c": "x1e5"}')) == \
        ['{"a": 1e400, "b": 9007199254740993e0}', '{"c":"x1e5"}']


def test_payloads_beyond_a_doubles_digits_stay_apart(spark):
    texts = ['{"a":9007199254740993e0}', '{"a":9007199254740992e0}', '{"a":1e400}', '{"a":1e-400}', '{"a":"Infinity"}', '{"a":0.0}',
             '{"a":0.1e1}', '{"a":1.0}', '{"a":1}']
    recs = spark.createDataFrame([(t, "f", k) for k, t in enumerate(texts)], "record_json string, source_file string, k long") \
        .withColumn("ingestion_timestamp", F.timestamp_seconds(1_700_000_000 + F.col("k")))
    shaped = wrap_payload(recs, "record_json", None)
    assert shaped.where(f"{REFUSED} IS NOT NULL").count() == 0
    rows = with_identity(shaped.select(*PAY.row_columns), PAY)
    latest = latest_for_spec(rows, PAY)
    want = {'{"a":9007199254740993}', '{"a":9007199254740992}', '{"a":1e400}', '{"a":1e-400}', '{"a":"Infinity"}', '{"a":0}', '{"a":1}'}
    assert sorted(r.payload for r in latest.collect()) == sorted(want)
    gold = latest.where("payload LIKE '%993}'").drop("_identity").withColumn(LAST_UPDATED, F.col("ingestion_timestamp"))
    for strategy in ("auto", "shuffle"):
        fresh = merge_insert_only(with_identity(gold, PAY), latest, "_identity", PAY.row_columns, fx.NOW, strategy=strategy)
        assert {r.payload for r in fresh.collect()} == want - {'{"a":9007199254740993}'}
    stage = shaped.select(*PAY.row_columns, F.lit(fx.AS_OF).alias(PAY.partition_col))
    for strategy in ("window", "auto", "broadcast"):
        assert sorted(r.payload for r in unified_view(PAY, gold, stage, fx.AS_OF, strategy=strategy).collect()) == sorted(want)


@pytest.mark.parametrize("size", [1200, 1_000_000])
def test_refused_records_are_kept_whole(spark, size):
    refused = '{"order_ref":"5","deep":%s1%s,"note":"%s"}' % ("[" * 1100, "]" * 1100, "é" * size)
    recs = spark.createDataFrame([(OE.folder, "p/1", None, refused), (OE.folder, "p/2", None, '{"order_ref":"6"}'),
                                  (OE.folder, "p/3", None, '{"order_ref":"7","order_date":"never"}')],
                                 "folder string, path string, error string, record_json string")
    rows, bad, held = shape_folder(recs, OE, fx.NOW)
    assert [r.source_file for r in rows.collect()] == ["p/2"]
    got = {r.source_file: (r[REFUSED_RECORD], r.error) for r in bad.collect()}
    assert got == {"p/1": (refused, "unreadable record"), "p/3": (None, "invalid DATE for order_date: 'never'")}


def test_rejects_of_typed_rows_have_no_record_text(spark):
    raw = project_explicit(spark.createDataFrame([('{"record_id":"1"}', "mine")], "record_json string, other string"), OE)
    good, bad = split_rejects(raw, OE)
    assert REFUSED_RECORD not in good.columns and "other" in good.columns and REFUSED_RECORD in bad.columns

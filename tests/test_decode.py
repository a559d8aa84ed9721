import gzip
import os

import pytest

from tidemark.operators.decode import DecodeError, decode_blob, decode_objects, decode_paths

GZ = gzip.compress

# FIXTURES.md §2 decode cases: (content, n_records or None for an error, error kind)
CASES = {
    "array": (GZ(b'[{"record_id":"r1","status":5},{"record_id":null}]'), 2, None),
    "ndjson": (GZ(b'{"record_id":"r2"}\n\n{"record_id":"r3"}\n'), 2, None),
    "blank": (GZ(b"   \n  "), 0, None),
    "bad_line": (GZ(b'{"a":1}\n{oops'), None, "json"),
    "trailing": (GZ(b'{"a":1} trash'), None, "json"),
    "pretty": (GZ(b'{\n  "a": 1\n}'), None, "json"),
    "not_gzip": (b"notgzip", None, "gzip"),
    "not_utf8": (GZ(b"\xff\xfe"), None, "utf8"),
    "bom": (GZ("\ufeff".encode() + b'{"a":1}'), None, "json"),
    "scalars": (GZ(b"[1,2]"), None, "not_object"),
    "dup_keys": (GZ(b'{"a":1,"a":2}'), 1, None),
    "extra_keys": (GZ(b'{"zzz":1}'), 1, None),
}


@pytest.mark.parametrize("case", sorted(CASES))
def test_decode_blob_cases(case):
    data, n, kind = CASES[case]
    if n is None:
        with pytest.raises(DecodeError) as e:
            decode_blob(data)
        assert e.value.kind == kind
    else:
        assert len(decode_blob(data)) == n


def test_duplicate_key_keeps_last():
    assert decode_blob(GZ(b'{"a":1,"a":2}')) == ['{"a":2}']


def test_decode_objects_all_or_nothing(spark, local_tmp):
    root = os.path.join(local_tmp, "objs", "Order_Events")
    os.makedirs(root)
    for name, (data, _, _) in CASES.items():
        with open(os.path.join(root, f"{name}.json.gz"), "wb") as f:
            f.write(data)
    files = spark.read.format("binaryFile").load(root)
    out = {r["name"]: (r["n"], r["err"]) for r in decode_objects(files)
           .selectExpr("regexp_extract(path, '([a-z_0-9]+)\\\\.json\\\\.gz$', 1) AS name",
                       "record_json", "error")
           .groupBy("name").agg({"record_json": "count", "error": "max"})
           .withColumnRenamed("count(record_json)", "n").withColumnRenamed("max(error)", "err")
           .collect()}
    for name, (_, n, kind) in CASES.items():
        if n == 0 and kind is None:
            assert name not in out  # blank object: no rows at all
        elif kind is None:
            assert out[name] == (n, None)
        else:
            assert out[name][0] == 0 and out[name][1].startswith(kind + ":")


def test_decode_paths_missing_object(spark, local_tmp):
    good = os.path.join(local_tmp, "Order_Events", "a.json.gz")
    os.makedirs(os.path.dirname(good))
    with open(good, "wb") as f:
        f.write(GZ(b'{"record_id":"x"}'))
    df = spark.createDataFrame(
        [(f"file://{good}", "Order_Events"), (f"file://{local_tmp}/nope.json.gz", "Order_Events")],
        "path string, folder string")
    rows = sorted(decode_paths(df).collect(), key=lambda r: r["path"])
    assert rows[0]["record_json"] == '{"record_id":"x"}' and rows[0]["folder"] == "Order_Events"
    assert rows[1]["record_json"] is None and rows[1]["error"].startswith("read:")


def test_every_object_is_accounted_for(spark):
    """|objects with records| + |dead objects| + |blank objects| = |objects|,
    and no object is both (all-or-nothing)."""
    from pyspark.sql import functions as F

    from tidemark import fixtures as fx
    from tidemark.plans.jobs import decode_listing
    from tidemark.sources.objects import list_objects

    ev = fx.table(spark, "/root/testdata/sf0.001", "events")
    root, manifest = fx.event_objects(ev, "/root/testdata/sf0.001", fx.BAD_FILE_LAYOUT)
    dec = decode_listing(list_objects(spark, root, "Order_Events", "2000-01-01"), root)
    per = dec.groupBy("path").agg(F.count("record_json").alias("n"),
                                  F.count("error").alias("e")).collect()
    assert len(per) == manifest.count()
    assert all((r["n"] == 0 and r["e"] == 1) or (r["n"] > 0 and r["e"] == 0) for r in per)
    assert not [r for r in per if r["n"] > 0 and r["e"] > 0]
    good = dec.filter("error IS NULL").count()
    assert good == ev.filter("event_type IN ('click', 'view')").count()


EXTRA = {
    "lead_trail_ws": GZ(b'\n  \n  {"a":1}\n{"b":2}  \n\n'),
    "bad_last_ws": GZ(b'{"a":1}\n{"b":2 \n\n'),
    "crlf": GZ(b'{"a":1}\r\n{"b":2}\r\n'),
    "unicode_seps": GZ('{"a":1} {"b":"é"}\x85{"c":3}'.encode()),
    "late_utf8": GZ(b'{"a":1}\n' * 50 + b'{oops}\n' + b'\xff\n'),
    "truncated": GZ(b'{"a":1}\n' * 200)[:-12],
    "json_then_ok": GZ(b'{oops\n' + b'{"a":1}\n' * 100),
    "scalar_line": GZ(b'{"a":1}\n5\n'),
    "array_ws": GZ(b'  \n [ {"a": 1} ,\n {"b": [1, 2, {"c": "x]y,z"}]} , {"n": 123456789} ]  \n'),
    "array_empty": GZ(b'[ ]'),
    "array_trailing_comma": GZ(b'[{"a":1},]'),
    "array_truncated": GZ(b'[{"a":1},{"b":'),
    "array_scalar": GZ(b'[{"a":1}, 7]'),
    "array_extra": GZ(b'[{"a":1}] x'),
    "array_two": GZ(b'[{"a":1}] [{"b":2}]'),
    "array_nbsp_tail": GZ('[{"a":1}]\u00a0 \n'.encode()),
    "array_big": GZ(b'[' + b','.join(b'{"k":%d,"s":"%s"}' % (i, b"x" * (i % 13)) for i in range(300)) + b']'),
    "array_late_utf8": GZ(b'[{"a":1},' + b'{"b":2},' * 40 + b'{"c":"\xff"}]'),
    "array_missing_sep": GZ(b'[{"a":1} {"b":2}]'),
}


def _whole_object(data):
    """What the rules say of an object, judged on its whole text."""
    import json
    import zlib

    try:
        raw = gzip.decompress(data)
    except (OSError, EOFError, zlib.error):
        return "gzip"
    try:
        text = raw.decode().strip()
    except UnicodeDecodeError:
        return "utf8"
    try:
        values = json.loads(text) if text[:1] == "[" else [json.loads(x) for x in text.splitlines() if x.strip()]
    except (ValueError, RecursionError):
        return "json"
    if not all(isinstance(v, dict) for v in values):
        return "not_object"
    out = [json.dumps(v, ensure_ascii=False, separators=(",", ":")) for v in values]
    try:
        "".join(out).encode()
    except UnicodeEncodeError:
        return "json"
    return out


def _decoded(data):
    from tidemark.operators import decode as D

    try:
        return list(D.iter_records(data))
    except DecodeError as e:
        return e.kind


EXTRA |= {
    "array_mixed_errors": GZ(b"[1, {oops]"),
    "lines_mixed_errors": GZ(b"1\n{oops"),
    "surrogate": GZ(b'{"record_id":"\\ud800"}'),
    "empty_gzip": GZ(b""),
    "deep": GZ(b"[" * 2000),
    "cr_runs": GZ(b'{"a":1}\r\r\n{"b":1}\r'),
    "nbsp_first": GZ('\u00a0 {"a":1}\r\n\r,\x85\r'.encode()),
}


@pytest.mark.parametrize("hold", [0, 8 << 20])
@pytest.mark.parametrize("piece", [1, 7, 1 << 18])
@pytest.mark.parametrize("case", sorted(set(CASES) | set(EXTRA)))
def test_decode_at_every_size(case, piece, hold, monkeypatch):
    """Piece and holding size stand for an object's size: neither changes
    records or kinds."""
    from tidemark.operators import decode as D

    data = CASES[case][0] if case in CASES else EXTRA[case]
    monkeypatch.setattr(D, "HOLD_BYTES", hold)
    monkeypatch.setattr(D, "_PIECE", piece)
    assert _decoded(data) == _whole_object(data)


def test_decode_fuzz(monkeypatch):
    import random

    from tidemark.operators import decode as D

    rng = random.Random(7)
    parts = ['{"a":1}', '{"b":"x\\n"}', "[", "]", ",", "\n", "\r\n", "\r", " ", "\u2028", "\x85", "5", "{", '"é"', "tru",
             "\u00a0", '{"c":[1,{"d":2}]}']
    for k in range(1500):
        data = GZ("".join(rng.choice(parts) for _ in range(rng.randint(0, 9))).encode())
        monkeypatch.setattr(D, "_PIECE", rng.choice([1, 2, 5, 1 << 18]))
        assert _decoded(data) == _whole_object(data)


def test_decode_time_and_memory_are_bounded(monkeypatch):
    """Four times the size takes about four times as long; a one-line array
    holds no more than the held records, a malformed one nothing."""
    import time
    import tracemalloc

    from tidemark.operators import decode as D

    monkeypatch.setattr(D, "HOLD_BYTES", 0)  # both sizes are read twice

    def array(n, start=b"["):
        return GZ(start + b",".join(b'{"k":%d,"s":"%s"}' % (i, b"x" * 60) for i in range(n)) + b"]", 1)

    def seconds(data):
        best = []
        for _ in range(3):
            t = time.process_time()
            _decoded(data)
            best.append(time.process_time() - t)
        return min(best)

    assert seconds(array(160_000)) <= 6 * seconds(array(40_000))
    one_line = GZ(b'{"a":"' + b"x" * (8 << 20) + b'"}', 1)
    assert seconds(GZ(b'{"a":"' + b"x" * (32 << 20) + b'"}', 1)) <= 8 * max(0.02, seconds(one_line))
    bad = array(200_000, b'[{"k":1},{"z" 5},')
    tracemalloc.start()
    assert _decoded(bad) == "json"
    assert tracemalloc.get_traced_memory()[1] < 8 << 20
    tracemalloc.stop()


def test_object_that_changes_between_readings(monkeypatch):
    import io

    from tidemark.operators import decode as D

    monkeypatch.setattr(D, "HOLD_BYTES", 0)
    versions = [GZ(b'{"a":1}\n{"a":2}'), GZ(b'{"a":1}\n{"a":3}')]
    rows = list(D._object_rows(lambda: D.iter_records(lambda: io.BytesIO(versions.pop(0)))))
    assert rows[-1][2].startswith("changed:")
    gone = [GZ(b'{"a":1}')]
    rows = list(D._object_rows(lambda: D.iter_records(lambda: io.BytesIO(gone.pop()))))
    assert rows[-1][2].startswith("changed:")


def test_unknown_scheme_fails_on_the_driver():
    from tidemark.operators.decode import openable_scheme, scheme_of

    assert scheme_of("s3a://bucket/x") == "s3" and openable_scheme("/plain/path") == "file"
    with pytest.raises(ValueError, match="oss"):
        openable_scheme("oss://bucket/x")


def test_listing_by_uri_and_by_content_agree(spark, monkeypatch):
    """A store that only Spark's readers open is decoded from the content."""
    from pyspark.sql import functions as F

    from tidemark import fixtures as fx
    from tidemark.plans import jobs
    from tidemark.sources.objects import list_objects

    ev = fx.table(spark, "/root/testdata/sf0.001", "events")
    root, _ = fx.event_objects(ev, "/root/testdata/sf0.001", fx.BAD_FILE_LAYOUT)
    objs = list_objects(spark, root, "Order_Events", "2000-01-01")

    def rows():
        d = jobs.decode_listing(objs, root)
        return sorted(map(tuple, d.select("path", "ordinal", "record_json", "folder", "error",
                                          F.col("modificationTime").isNotNull().alias("t")).collect()), key=repr)

    by_uri = rows()
    monkeypatch.setattr(jobs, "OPENABLE", ())
    assert rows() == by_uri

"""Very many small objects: listed by tasks also by the stream (F1, F2) and by
the decode queries (F5, F6), decoded in one pass each."""

import datetime as dt
import gzip
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as entry
from tests.test_jobs import NOW, cfg_for
from tidemark.operators import decode
from tidemark.plans.storage import path_exists
from tidemark.sources import objects as src
from tidemark.specs import ORDER_EVENTS as OE
from tidemark.streaming import ingest


def put(root, name, ref):
    path = f"{root.removeprefix('file:')}/{name}"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(gzip.compress(f'{{"order_ref":"{ref}"}}'.encode()))
    return path


def run(spark, cfg, ckpt, **more):
    ingest.stream_ingest(spark, cfg, ckpt, available_now=True, now_fn=lambda: NOW, **more).awaitTermination()
    return sorted(r[0] for r in cfg.stage(OE).read(spark).select("order_ref").collect())


def test_the_stream_lists_by_tasks_and_sees_each_object_once(spark, tmp, monkeypatch):
    cfg, ckpt = cfg_for(tmp), f"{tmp}/ck"
    monkeypatch.setattr(src, "_LISTINGS_KEPT", 1)
    want = []
    for k in range(3):
        path = put(cfg.objects_root, f"Order_Events/d{k % 2}/o{k}.json.gz", f"r{k}")
        at = dt.datetime(2020, 1, 1).timestamp() - k * 86400  # later ones are older
        os.utime(path, (at, at))
        put(cfg.objects_root, f"Order_Events/_hidden/o{k}.json.gz", "hidden")
        want.append(f"r{k}")
        assert run(spark, cfg, ckpt) == want
    assert not path_exists(spark, f"{ckpt}/sources/0/1")  # no file source's log, which the driver holds
    assert len(os.listdir(src.objects_seen(ckpt).removeprefix("file:"))) <= 3


def test_a_replayed_batch_gets_the_same_objects(spark, tmp):
    cfg = cfg_for(tmp)
    put(cfg.objects_root, "Order_Events/a.json.gz", "a")
    first = src.new_objects(spark, cfg.objects_root, f"{tmp}/ck", 0, cfg.lake_root).collect()
    put(cfg.objects_root, "Order_Events/b.json.gz", "b")
    assert src.new_objects(spark, cfg.objects_root, f"{tmp}/ck", 0, cfg.lake_root).collect() == first and len(first) == 1
    assert [r.name for r in src.new_objects(spark, cfg.objects_root, f"{tmp}/ck", 1, cfg.lake_root).collect()] == ["Order_Events/b.json.gz"]


def test_a_file_source_s_checkpoint_goes_on(spark, tmp):
    cfg, ckpt = cfg_for(tmp), f"{tmp}/ck"
    put(cfg.objects_root, "Order_Events/a.json.gz", "a")
    assert run(spark, cfg, ckpt, max_files_per_trigger=1) == ["a"]
    put(cfg.objects_root, "Order_Events/b.json.gz", "b")
    assert run(spark, cfg, ckpt) == ["a", "b"]
    assert not path_exists(spark, src.objects_seen(ckpt))


def test_the_driver_lists_no_objects(spark, tmp):
    """What the driver's file indexes hold does not follow the number of objects,
    neither in the stream nor in the daily re-read (F2)."""
    from tidemark.plans.jobs import daily_reprocess

    found = spark._jvm.org.apache.spark.metrics.source.HiveCatalogMetrics.METRIC_FILES_DISCOVERED()
    listed, objects = [], (3, 300)
    for n in objects:
        cfg = cfg_for(f"{tmp}/{n}")
        for k in range(n):
            put(cfg.objects_root, f"{'Order_Events' if k % 3 else 'Other'}/d{k % 2}/o{k}.json.gz", f"r{k}")
        before = found.getCount()
        assert len(run(spark, cfg, f"{tmp}/{n}/ck")) == n - (n + 2) // 3
        daily_reprocess(spark, cfg, now=NOW, as_of=NOW.date())
        listed.append(found.getCount() - before)
    assert listed[1] - listed[0] < (objects[1] - objects[0]) // 2


@pytest.mark.parametrize("part,strategy", [(16, "broadcast"), (1 << 40, "shuffle")])
def test_a_merge_broadcasts_what_the_driver_has_room_for(spark, tmp, monkeypatch, part, strategy):
    from tidemark.operators import merge
    from tidemark.plans.jobs import merge_folder

    monkeypatch.setattr(merge, "_HEAP_PART", part)
    heap = spark._jvm.java.lang.Runtime.getRuntime().maxMemory()
    assert merge.broadcast_limit(spark, 1 << 60) == heap // part and merge.broadcast_limit(spark, 0) == 0
    cfg = cfg_for(tmp)
    rows = [(k % 5, f"2024-01-3{k % 2}") for k in range(20)]
    stage = spark.createDataFrame(rows, "k int, day string").select(
        *(F.col("k").cast("string").alias(c) if c == OE.key else F.col("day").cast(t).alias(c) if t in (T.DateType(), T.TimestampType())
          else F.lit(None).cast(t).alias(c) for c, t in ((f.name, f.dataType) for f in OE.stage_schema())))
    cfg.stage(OE).append(stage, "b")
    done = merge_folder(spark, cfg, OE, NOW.date(), 2, NOW)
    assert done["strategy"] == strategy
    assert sorted(r[0] for r in cfg.gold(OE).read(spark).select(OE.key).collect()) == list("01234")


def test_a_root_that_is_not_there_is_refused(spark, tmp):
    from pyspark.errors import AnalysisException

    cfg = cfg_for(tmp)
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        ingest.stream_ingest(spark, cfg, f"{tmp}/ck", available_now=True)


@pytest.mark.parametrize("query", ["decode_ndjson", "decode_odd_objects"])
def test_decode_queries_list_by_tasks(spark, query):
    plan = entry.queries()[query](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "binaryFile" not in plan


def test_small_objects_skip_the_general_reader(monkeypatch):
    good = gzip.compress(b'{"a":1}\n{"a":12345678901234567890}\n{"a":1e400,"b":"2e3"}')
    want = ['{"a":1}', '{"a":12345678901234567890}', '{"a":1e400,"b":"2e3"}']
    big = gzip.compress(b"".join(b'{"a":"%06d"}\n' % k for k in range(100_000)))
    assert len(decode.decode_blob(big)) == 100_000
    assert decode.decode_blob(good + gzip.compress(b'\n{"c":2}')) == [*want, '{"c":2}']  # two members
    assert decode.decode_blob(good + b"\0" * 8) == want  # padding
    for bad, kind in ((good[:-3], "gzip"), (good[:-8] + b"\0" * 8, "gzip"), (good + b"x", "gzip"), (b"plain", "gzip"), (gzip.compress(b"\xff"), "utf8")):
        with pytest.raises(decode.DecodeError) as e:
            decode.decode_blob(bad)
        assert e.value.kind == kind
    monkeypatch.setattr(decode.gzip, "GzipFile", None)
    assert decode.decode_blob(good) == want


def test_written_objects_hold_their_own_records(local_tmp):
    import pandas as pd

    from tidemark import fixtures as fx

    write = fx._object_writer(local_tmp, {"view": fx.GOOD_ARRAY, "error": fx.NOT_GZIP, "signup": fx.BLANK}, fx.GOOD_NDJSON)
    long = '{"t":"' + "x" * fx._HELD_CHARS + '"}'  # more than is held
    rows = pd.DataFrame([("F/a", "click", long), ("F/a", "click", "{}"), ("F/b", "view", "{}"), ("F/b", "view", long), ("F/c", "error", "{}"), ("F/d", "signup", "{}")],
                        columns=["name", "event_type", "record_json"])
    out = next(write(iter([rows[:1], rows[1:]])))
    assert list(map(tuple, out.values.tolist())) == [("F/a", 2), ("F/b", 2), ("F/c", 1), ("F/d", 0)]
    content = {n: open(f"{local_tmp}/F/{n}", "rb").read() for n in "abcd"}
    assert decode.decode_blob(content["a"]) == [long, "{}"] and decode.decode_blob(content["b"]) == ["{}", long]
    assert content["c"] == b"{}" and gzip.decompress(content["d"]) == b""
    with pytest.raises(ValueError):
        next(write(iter([pd.DataFrame({"name": [None], "event_type": ["click"], "record_json": ["{}"]})])))

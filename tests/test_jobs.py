import datetime as dt
import os

import pytest

from tidemark import fixtures as fx
from tidemark.operators.deadletter import read_dead_letters
from tidemark.plans.jobs import PipelineConfig, daily_reprocess
from tidemark.sources.objects import lookback_cutoff, parse_execution_date
from tidemark.specs import ORDER_EVENTS as OE, default_registry
from tidemark.streaming.ingest import stream_ingest

SF = "/root/testdata/sf0.001"
NOW = dt.datetime(2024, 1, 31, 12, tzinfo=dt.timezone.utc)


def cfg_for(base):
    return PipelineConfig(lake_root=f"{base}/lake", objects_root=f"{base}/objects",
                          registry=default_registry())


def test_execution_date_rules():
    assert parse_execution_date("2024-01-30T12:00:00+02:00") == dt.datetime(2024, 1, 30, 10, tzinfo=dt.timezone.utc)
    assert lookback_cutoff("2024-01-30") == dt.datetime(2024, 1, 28, tzinfo=dt.timezone.utc)
    with pytest.raises(ValueError):
        parse_execution_date("yesterday")


def test_stream_equals_batch_and_restart_adds_nothing(spark, tmp):
    cfg = cfg_for(tmp)
    ev = fx.table(spark, SF, "events")
    fx.write_event_objects(ev, cfg.objects_root, layouts={"error": fx.BAD_LINE})
    ckpt = f"{tmp}/ckpt"
    q = stream_ingest(spark, cfg, ckpt, available_now=True, now_fn=lambda: NOW)
    q.awaitTermination()
    stage = cfg.stage(OE).read(spark)
    n_good = ev.filter("event_type <> 'error'").count()
    assert stage.count() == n_good
    # same files again through the batch path: same rows
    batch = cfg_for(f"{tmp}/b")
    batch.objects_root = cfg.objects_root
    daily_reprocess(spark, batch, "2024-01-30", now=NOW, as_of=fx.AS_OF)
    cols = OE.business_columns
    a = sorted(map(tuple, stage.select(*cols).collect()))
    b = sorted(map(tuple, batch.stage(OE).read(spark).select(*cols).collect()))
    assert a == b
    # restart from the checkpoint: nothing new
    q = stream_ingest(spark, cfg, ckpt, available_now=True, now_fn=lambda: NOW)
    q.awaitTermination()
    assert cfg.stage(OE).read(spark).count() == n_good
    # every bad object produced exactly one dead letter
    dl = read_dead_letters(spark, cfg.dead_letters)
    n_bad_files = ev.filter("event_type = 'error'").select("user_id").distinct().count()
    assert dl.filter("data LIKE '%json:%'").count() == n_bad_files


def test_unknown_folder_goes_to_dead_letter(spark, tmp):
    cfg = cfg_for(tmp)
    ev = fx.table(spark, SF, "events").filter("event_type = 'click'")
    fx.write_event_objects(ev, cfg.objects_root, folder="Other")
    q = stream_ingest(spark, cfg, f"{tmp}/ck", available_now=True, now_fn=lambda: NOW)
    q.awaitTermination()
    dl = read_dead_letters(spark, cfg.dead_letters).collect()
    assert dl and all('"table":"unknown"' in r["attributes"] for r in dl)
    assert all("Unrecognised folder: Other" in r["data"] for r in dl)


def test_failed_stage_write_fans_out_dead_letters(spark, tmp):
    cfg = cfg_for(tmp)
    ev = fx.table(spark, SF, "events")
    written = fx.write_event_objects(ev, cfg.objects_root)
    # make the stage location unusable: a plain file where the table folder goes
    os.makedirs(f"{cfg.lake_root.replace('file:', '')}/stage", exist_ok=True)
    with open(f"{cfg.lake_root.replace('file:', '')}/stage/{OE.stage_table}", "w") as f:
        f.write("not a folder")
    with pytest.raises(Exception):
        daily_reprocess(spark, cfg, "2024-01-30", now=NOW, as_of=fx.AS_OF)
    dl = read_dead_letters(spark, cfg.dead_letters)
    assert dl.filter('attributes LIKE \'%"table":"STG_Order_Events"%\'').count() == written.count()
    assert cfg.gold(OE).current_version(spark) is None  # no merge after a failed append


def test_batch_clock_is_fixed_per_batch(spark, tmp):
    from tidemark.streaming.ingest import batch_clock

    t1 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    t2 = dt.datetime(2024, 1, 2, tzinfo=dt.timezone.utc)
    assert batch_clock(spark, tmp, 7, lambda: t1) == t1
    assert batch_clock(spark, tmp, 7, lambda: t2) == t1  # replay: first clock wins
    assert batch_clock(spark, tmp, 8, lambda: t2) == t2


def test_empty_window_merge_writes_nothing(spark, tmp):
    from tidemark.plans.jobs import hourly_merge

    cfg = cfg_for(tmp)
    gold, _ = fx.explicit_layers(fx.table(spark, SF, "events"))
    cfg.gold(OE).commit(spark, gold)
    out = {m["folder"]: m for m in hourly_merge(spark, cfg, fx.AS_OF, NOW)}
    assert out["Order_Events"]["strategy"] == "none" and out["Order_Events"]["version"] == 1


def test_notification_stream_payload_partition_is_never_null(spark, tmp):
    from pyspark.sql import functions as F

    from tidemark.specs import NOTIFICATION_EVENTS as PAY

    cfg = cfg_for(tmp)
    ev = fx.table(spark, SF, "events").filter("event_type = 'view'")
    written = fx.write_event_objects(ev, cfg.objects_root, folder=PAY.folder)
    root = cfg.objects_root.removeprefix("file:")
    notif = written.select(
        F.col("name").alias("message_id"), F.lit(None).cast("timestamp").alias("publish_time"),
        F.create_map(F.lit("eventType"), F.lit("OBJECT_FINALIZE"), F.lit("objectId"), F.col("name"),
                     F.lit("bucketId"), F.lit(root)).alias("attributes"),
        F.lit(None).cast("string").alias("data"))
    notif.unionByName(notif).write.json(f"{tmp}/notif")  # every message delivered twice
    stream_ingest(spark, cfg, f"{tmp}/ck", source="notifications", notifications_path=f"{tmp}/notif",
                  scheme="file", available_now=True, now_fn=lambda: NOW).awaitTermination()
    stage = cfg.stage(PAY).read(spark)
    assert stage.count() == ev.count()
    assert stage.filter("_partition_date IS NULL").count() == 0
    assert stage.select("_partition_date").distinct().collect()[0][0] == NOW.date()


def test_rerun_keeps_the_gold_version(spark, tmp):
    from tidemark.plans.jobs import hourly_merge

    cfg = cfg_for(tmp)
    gold, stage = fx.explicit_layers(fx.table(spark, SF, "events"))
    cfg.gold(OE).commit(spark, gold)
    cfg.stage(OE).append(stage, "b1")
    first = {m["folder"]: m for m in hourly_merge(spark, cfg, fx.AS_OF, NOW)}["Order_Events"]
    rows = sorted(map(tuple, cfg.gold(OE).read(spark).collect()), key=repr)
    again = {m["folder"]: m for m in hourly_merge(spark, cfg, fx.AS_OF, NOW)}["Order_Events"]
    assert first["version"] == 2 and again["strategy"] == "unchanged" and again["version"] == 2
    assert sorted(map(tuple, cfg.gold(OE).read(spark).collect()), key=repr) == rows


def test_merges_vacuum_old_versions_and_expire_stage(spark, tmp):
    from tidemark.plans.jobs import hourly_merge
    cfg = cfg_for(tmp)
    cfg.keep_versions = 2
    gold, stage = fx.explicit_layers(fx.table(spark, SF, "events"))
    g = cfg.gold(OE)
    g.commit(spark, gold)
    g.commit(spark, gold)
    g.commit(spark, gold)
    cfg.stage(OE).append(stage, "b1")
    out = {m["folder"]: m for m in hourly_merge(spark, cfg, fx.AS_OF, NOW)}["Order_Events"]
    assert out["version"] == 4
    assert g.versions(spark) == [3, 4]
    assert "p_date=2024-01-23" in out["expired"]


def test_listing_finds_objects_under_any_prefix(spark, tmp):
    """Only the update time selects: an object written (or overwritten) now
    under an old date's prefix is read again."""
    from tidemark.sources.objects import list_objects

    cfg = cfg_for(tmp)
    ev = fx.table(spark, SF, "events")
    for d in ("2024-01-20", "2024-01-30"):
        part = ev.filter(f"CAST(ts AS DATE) = DATE'{d}'")
        fx.write_event_objects(part, cfg.objects_root, folder=f"Order_Events/dt={d}")
    objs = list_objects(spark, cfg.objects_root, "Order_Events", "2024-01-28T12:00:00Z")
    assert {r["name"].split("/")[1] for r in objs.select("name").collect()} == {"dt=2024-01-20", "dt=2024-01-30"}


def test_stream_reads_objects_with_old_time_stamps(spark, tmp, local_tmp):
    """Files of any age are new to a stream that hasn't read them."""
    import gzip
    import os
    import time

    from tidemark.sources.objects import stream_objects

    root = f"{local_tmp}/objs/Order_Events"
    os.makedirs(root)

    def put(name, days):
        with open(f"{root}/{name}.json.gz", "wb") as f:
            f.write(gzip.compress(b'{"a":1}'))
        t = time.time() - days * 86400
        os.utime(f"{root}/{name}.json.gz", (t, t))

    seen = []

    def run():
        q = stream_objects(spark, f"{local_tmp}/objs").select("name").writeStream.foreachBatch(
            lambda d, _: seen.extend(r["name"] for r in d.collect())) \
            .option("checkpointLocation", f"{local_tmp}/ck").trigger(availableNow=True).start()
        q.awaitTermination()

    put("new", 0)
    run()
    put("old", 30)
    run()
    assert sorted(seen) == ["Order_Events/new.json.gz", "Order_Events/old.json.gz"]

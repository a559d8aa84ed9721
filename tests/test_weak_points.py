"""Listing by tasks (S3), pruned letters (F6), bucketed gold (M1), single-pass
inserts (M2), written micro-batches (L1), clustered stage files (T1)."""

import datetime as dt
import gzip
import os

import pytest
from pyspark.sql import functions as F

from tests.test_jobs import NOW, cfg_for
from tidemark import fixtures as fx
from tidemark.operators.merge import merge_plan
from tidemark.plans import jobs
from tidemark.plans.storage import GoldStore, StageStore, write_bucketed
from tidemark.sources.objects import list_changed, list_objects
from tidemark.specs import LAST_UPDATED, NOTIFICATION_EVENTS as PAY, ORDER_EVENTS as OE
from tidemark.streaming import ingest

SF = "/root/testdata/sf0.001"


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


# -- S3 --------------------------------------------------------------------------

@pytest.mark.parametrize("prefix", ["", "file:", "file://"])
def test_listing_by_tasks_equals_the_file_index(spark, local_tmp, prefix):
    def put(name, days=0):
        path = f"{local_tmp}/objs/{name}"
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as f:
            f.write(gzip.compress(b'{"a":1}'))
        at = dt.datetime(2024, 1, 30, tzinfo=dt.timezone.utc).timestamp() - days * 86400 + 0.123456
        os.utime(path, (at, at))

    for k in range(40):
        put(f"Order_Events/y={k % 3}/d={k % 7}/o{k}.json.gz", k % 5)
    for name in ("Order_Events/top.json.gz", "Order_Events/with space/é #1?.json.gz", "Order_Events/_hidden/x.json.gz", "Order_Events/.dot.json.gz",
                 "Order_Events/_part.json.gz", "Order_Events/readme.txt", "Order_Events2/x.json.gz", "Order_Events/y=0/.tmp/x.json.gz"):
        put(name)
    os.makedirs(f"{local_tmp}/objs/Order_Events/empty/inner")
    root = f"{prefix}{local_tmp}/objs"
    for cutoff in ("2000-01-01", "2024-01-28T00:00:00Z", "2024-01-30T00:00:00.123Z", "2100-01-01"):
        want = list_objects(spark, root, "Order_Events", cutoff).select("path", "modificationTime", "length", "name").collect()
        held = []
        got = list_changed(spark, root, "Order_Events", cutoff, f"{local_tmp}/lake", held).collect()
        # Spark percent-encodes names in its paths; names of plain ones are equal
        plain = lambda rows: sorted(tuple(r) for r in rows if " " not in r.path and "%20" not in r.path)
        assert plain(got) == plain(want) and len(got) == len(want)
        assert len(held) == 3 and all(os.path.isdir(p) for p in held)  # one for each level of folders
    assert list_changed(spark, root, "Nothing", "2000-01-01").count() == 0


def test_listed_objects_are_opened(spark, local_tmp):
    os.makedirs(f"{local_tmp}/objs/Order_Events/a b")
    with open(f"{local_tmp}/objs/Order_Events/a b/é #1?.json.gz", "wb") as f:
        f.write(gzip.compress(b'{"a":1}'))
    rows = jobs.decode_listing(list_changed(spark, f"{local_tmp}/objs", "Order_Events", "2000-01-01"), f"{local_tmp}/objs").collect()
    assert [(r.folder, r.record_json, r.error) for r in rows] == [("Order_Events", '{"a":1}', None)]


# -- F6 --------------------------------------------------------------------------

def test_reported_letters_are_read_by_date(spark, tmp):
    cfg = cfg_for(tmp)
    _, stage = fx.explicit_layers(fx.table(spark, SF, "events"))
    cfg.stage(OE).append(stage.withColumn("record_id", F.when(F.col("category") != "error", F.col("record_id"))), "seed")
    counts = []
    for day in (0, 1, 1):  # the window moves, then is merged again
        jobs.hourly_merge(spark, cfg, fx.AS_OF + dt.timedelta(days=day), NOW + dt.timedelta(days=day))
        counts.append(jobs.read_dead_letters(spark, cfg.dead_letters).count())
    missing = stage.where(f"category = 'error' AND p_date >= DATE'{fx.AS_OF - dt.timedelta(days=OE.hourly_days)}'").count()
    assert counts == [missing] * 3 and missing
    seen = jobs.reported_letters(spark, cfg, fx.AS_OF)
    text = plan_text(seen)
    assert "PartitionFilters: [isnotnull(publish_date" in text and "ReadSchema: struct<message_id:string>" in text
    assert seen.count() == missing and jobs.reported_letters(spark, cfg, NOW.date() + dt.timedelta(days=9)).count() == 0


# -- M1 --------------------------------------------------------------------------

def test_merge_leaves_a_bucketed_gold_table_where_it_is(spark, tmp):
    gold, stage = fx.explicit_layers(fx.table(spark, SF, "events"))
    src = jobs.merge_source(stage, OE, fx.AS_OF, 1).where("record_id IS NOT NULL")
    write_bucketed(gold, "tidemark_test_gold", OE.key, f"{tmp}/bucketed")
    try:
        before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            plan = merge_plan(spark.table("tidemark_test_gold"), src, OE.key, OE.order_col, OE.row_columns, "shuffle")
            lines = plan_text(plan).splitlines()
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
            spark.conf.set("spark.sql.adaptive.enabled", "true")
        scan = next(k for k, line in enumerate(lines) if "tidemark_test_gold" in line)
        join = next(k for k, line in enumerate(lines) if "SortMergeJoin" in line)
        assert "Bucketed: true" in lines[scan]
        assert join < scan and not any("Exchange" in line for line in lines[join:scan])  # gold is the join's first child
        want = merge_plan(gold, src, OE.key, OE.order_col, OE.row_columns, "shuffle")
        assert sorted(map(tuple, plan.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    finally:
        spark.sql("DROP TABLE IF EXISTS tidemark_test_gold")


# -- M2 --------------------------------------------------------------------------

def test_insert_only_computes_its_rows_once_and_old_versions_go(spark, tmp):
    cfg = cfg_for(tmp)
    cfg.keep_versions = 2
    pgold, pstage = fx.payload_layers(fx.table(spark, SF, "events"))
    g = cfg.gold(PAY)
    for _ in range(3):
        g.commit(spark, pgold)
    seen = spark.sparkContext.accumulator(0)
    once = F.udf(lambda x: (seen.add(1), x)[1], "string").asNondeterministic()
    rows = pgold.withColumn("payload", F.concat(once("payload"), F.lit(" ")))
    assert g.append(spark, rows) == 4
    assert seen.value == pgold.count() > 0
    assert g.append(spark, rows.limit(0)) == 4  # none: no version, and no folder left
    assert len(os.listdir(f"{tmp}/lake/gold/{PAY.gold_table}/data".removeprefix("file:"))) == 4
    cfg.stage(PAY).append(pstage, "seed")
    out = {m["folder"]: m for m in jobs.hourly_merge(spark, cfg, fx.AS_OF, NOW)}[PAY.folder]
    assert out["version"] == 5 and g.versions(spark) == [4, 5]
    assert g.read(spark).where(F.col(LAST_UPDATED) == F.lit(NOW)).count()


def test_append_to_nothing_makes_the_first_version(spark, tmp):
    pgold, _ = fx.payload_layers(fx.table(spark, SF, "events"))
    g = GoldStore(f"{tmp}/gold", PAY)
    assert g.append(spark, pgold.limit(0)) == 1 and g.read(spark).count() == 0


# -- L1 --------------------------------------------------------------------------

@pytest.mark.parametrize("source", ["objects", "notifications"])
def test_a_micro_batch_is_decoded_once(spark, tmp, monkeypatch, source):
    """Both outputs read the written rows: with the objects emptied after that,
    stage and dead letters are complete all the same."""
    cfg = cfg_for(tmp)
    ev = fx.table(spark, SF, "events")
    names = fx.write_event_objects(ev, cfg.objects_root, fx.BAD_FILE_LAYOUT)
    real = ingest.ingest_decoded

    def after_the_objects_have_changed(spark_, cfg_, decoded, *rest):
        assert "tidemark_decoded" in decoded.inputFiles()[0]
        for folder, _, files in os.walk(cfg.objects_root):
            for name in files:
                if name.endswith(".json.gz"):
                    open(f"{folder}/{name}", "wb").close()
        return real(spark_, cfg_, decoded, *rest)

    monkeypatch.setattr(ingest, "ingest_decoded", after_the_objects_have_changed)
    checkpoint = f"{tmp}/ckpt"
    clock = lambda: NOW.replace(tzinfo=dt.timezone.utc)
    if source == "objects":
        body = ingest.object_batch_writer(spark, cfg, clock, checkpoint)
        batch = list_objects(spark, cfg.objects_root, "Order_Events", "2000-01-01")
    else:
        body = ingest.notification_batch_writer(spark, cfg, "file", clock, checkpoint)
        batch = names.select(F.create_map(F.lit("eventType"), F.lit("OBJECT_FINALIZE"), F.lit("objectId"), F.col("name"),
                                          F.lit("bucketId"), F.lit(cfg.objects_root)).alias("attributes"), F.col("name").alias("message_id"))
    body(batch, 0)
    assert cfg.stage(OE).read(spark).count() == ev.where("event_type IN ('click', 'view')").count()
    bad = ev.where("event_type IN ('error', 'signup', 'purchase')").select("event_type", "user_id").distinct().count()
    assert jobs.read_dead_letters(spark, cfg.dead_letters).count() == bad
    assert not os.listdir(f"{checkpoint}/tidemark_decoded")  # the copy goes with the batch


# -- T1 --------------------------------------------------------------------------

def test_readers_of_a_key_skip_row_groups(spark, tmp):
    ev = fx.table(spark, "/root/testdata/sf0.01", "events")
    _, stage = fx.explicit_layers(ev.withColumn("user_id", F.col("event_id")))  # very many keys
    stage = stage.where("p_date = DATE'2024-01-20'").unionByName(stage.withColumn("p_date", F.lit(dt.date(2024, 1, 20))))
    store = StageStore(f"{tmp}/stage", OE)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("parquet.block.size", str(64 << 10))
    conf.set("parquet.block.size.row.check.min", "10")
    conf.set("parquet.page.size.row.check.min", "10")
    try:
        store.append(stage.coalesce(1), "b1")
    finally:
        for k in ("parquet.block.size", "parquet.block.size.row.check.min", "parquet.page.size.row.check.min"):
            conf.unset(k)
    total = stage.count()

    def scanned(df):
        df.collect()
        node = df._jdf.queryExecution().executedPlan()
        while not node.nodeName().startswith("Scan"):
            node = node.finalPhysicalPlan() if node.nodeName() == "AdaptiveSparkPlan" else node.children().head()
        return node.metrics().get("numOutputRows").get().value()

    some = store.read(spark).where("record_id = '5000'").select("record_id", "order_ref")
    assert some.count() == stage.where("record_id = '5000'").count() > 0
    assert 0 < scanned(some) <= total // 5

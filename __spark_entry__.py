"""

``entry(spark)`` runs the flagship query (hourly merge of the Order_Events
stage into gold) on sf0.001. ``queries()`` holds one callable per operator
of SURVEY §2.13, each reading the driver's whole tables; ``oracle_sql()``
holds the independent DuckDB SQL for the same result.
"""

from __future__ import annotations

import datetime as dt
import importlib.util
import logging
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import fixtures as fx
from tidemark.functions.jsonfn import canonical_json, json_value
from tidemark.functions.timestamps import safe_timestamp
from tidemark.operators.dedup import latest_by_key, latest_for_spec, tie_breakers
from tidemark.operators.merge import (
    ACTION, checked_merge_plan, merge_actions, merge_insert_only, merge_plan, merge_upsert,
)
from tidemark.operators.quality import key_gate, split_rejects
from tidemark.operators.shape import REFUSED_RECORD, with_partition_date, with_provenance, wrap_payload
from tidemark.operators.views import stage_window, union_layers, unified_view, with_identity
from tidemark.functions.paths import relative_name
from tidemark.operators.deadletter import (
    SOURCE_BATCH, SOURCE_STREAM, fanout_dead_letters, file_dead_letters, read_dead_letters, row_dead_letters,
    union_dead_letters,
)
from tidemark.operators.route import TAG_DEAD, TAG_OBJECT, extract_object_path, route_by_folder
from tidemark.plans.jobs import (
    PipelineConfig, daily_reprocess, decode_listing, hourly_merge, merge_source, shape_folder,
)
from tidemark.plans.storage import write_bucketed
from tidemark.session import work_dir
from tidemark.sources.objects import filter_listing, list_changed, lookback_cutoff
from tidemark.specs import default_registry
from tidemark.streaming.ingest import stream_ingest
from tidemark.session import apply_session_conf
from tidemark.specs import INGESTION_TS, LAST_UPDATED, FolderSpec, NOTIFICATION_EVENTS as PAY, ORDER_EVENTS as OE

SF_SMOKE = "/root/testdata/sf0.001"


# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------
def _events(spark: SparkSession, sf: str) -> DataFrame:
    apply_session_conf(spark)
    return fx.table(spark, sf, "events")


def q_latest_by_key_events(spark, sf):
    ev = _events(spark, sf)
    return latest_by_key(ev, "user_id", "ts", ["event_id"])


def q_latest_by_key_lineitem(spark, sf):
    apply_session_conf(spark)
    li = fx.table(spark, sf, "lineitem")
    return latest_by_key(li, "l_orderkey", "l_shipdate",
                         ["l_linenumber", "l_partkey", "l_suppkey"])


def _stage_window(days):
    def q(spark, sf):
        _, stage = fx.explicit_layers(_events(spark, sf))
        return fx.as_ntz(stage_window(stage, fx.AS_OF, days, OE.partition_col))
    return q


def q_union_layers(spark, sf):
    gold, stage = fx.explicit_layers(_events(spark, sf))
    recent = stage_window(stage, fx.AS_OF, OE.view_days, OE.partition_col)
    return fx.as_ntz(union_layers(gold, recent, OE.row_columns))


def q_unified_view_explicit(spark, sf):
    gold, stage = fx.explicit_layers(_events(spark, sf))
    return fx.as_ntz(unified_view(OE, gold, stage, fx.AS_OF, strategy="window"))


def q_unified_view_explicit_broadcast(spark, sf):
    gold, stage = fx.explicit_layers(_events(spark, sf))
    return fx.as_ntz(unified_view(OE, gold, stage, fx.AS_OF, strategy="broadcast"))


def q_unified_view_payload_broadcast(spark, sf):
    gold, stage = fx.payload_layers(_events(spark, sf))
    return fx.as_ntz(unified_view(PAY, gold, stage, fx.AS_OF, strategy="broadcast"))


def q_unified_view_payload(spark, sf):
    gold, stage = fx.payload_layers(_events(spark, sf))
    return fx.as_ntz(unified_view(PAY, gold, stage, fx.AS_OF, strategy="window"))


def _merge_source(stage, days):
    ok, _ = key_gate(merge_source(stage, OE, fx.AS_OF, days), OE.key)
    return ok


def _merge_upsert(days, strategy):
    def q(spark, sf):
        gold, stage = fx.explicit_layers(_events(spark, sf))
        src = _merge_source(stage, days)
        return fx.as_ntz(merge_upsert(gold, src, OE.key, OE.order_col, OE.row_columns, strategy))
    return q


def q_merge_actions(spark, sf):
    gold, stage = fx.explicit_layers(_events(spark, sf))
    src = _merge_source(stage, OE.hourly_days)
    return merge_actions(merge_plan(gold, src, OE.key, OE.order_col, OE.row_columns, "shuffle"))


def q_merge_idempotent(spark, sf):
    gold, stage = fx.explicit_layers(_events(spark, sf))
    src = _merge_source(stage, OE.hourly_days)
    once = merge_plan(gold, src, OE.key, OE.order_col, OE.row_columns, "shuffle").drop(ACTION)
    twice = checked_merge_plan(once, src, OE.key, OE.order_col, OE.row_columns, "auto").drop(ACTION)
    return fx.as_ntz(twice)


def q_merge_insert_only(spark, sf):
    gold, stage = fx.payload_layers(_events(spark, sf))
    src = merge_source(stage, PAY, fx.AS_OF, PAY.hourly_days)
    gold_i = with_identity(gold, PAY)
    fresh = merge_insert_only(gold_i, src, "_identity", PAY.row_columns, fx.NOW, LAST_UPDATED,
                              strategy="auto")
    return fx.as_ntz(gold.unionByName(fresh))


def q_key_gate(spark, sf):
    ev = _events(spark, sf)
    rows = ev.select(
        F.nullif(F.col("user_id"), F.lit(0)).cast("string").alias("record_id"),
        F.col("event_id").cast("string").alias("order_ref"),
    )
    ok, bad = key_gate(rows, "record_id")
    return ok.withColumn("gate", F.lit("pass")).withColumn("error", F.lit(None).cast("string")) \
        .unionByName(bad.withColumn("gate", F.lit("reject")))


def _raw_dates(ev: DataFrame) -> DataFrame:
    day = F.date_format("ts", "yyyy-MM-dd")
    return ev.select(
        F.col("event_id").cast("string").alias("order_ref"),
        F.when(F.col("event_type") == "error", F.lit("not-a-date")).otherwise(day)
        .alias("order_date"),
        F.when(F.col("value") < 5, F.lit("2024-02-30"))
        .when(F.col("event_type") == "signup", F.lit(""))
        .otherwise(F.date_format(F.date_add(F.to_date("ts"), 2), "yyyy-MM-dd"))
        .alias("ship_date"),
    )


def q_split_rejects(spark, sf):
    raw = _raw_dates(_events(spark, sf))
    good, bad = split_rejects(raw, OE)
    return (
        good.withColumn("error", F.lit(None).cast("string"))
        .withColumn("outcome", F.lit("ok"))
        .unionByName(bad.select(
            "order_ref", F.lit(None).cast("date").alias("order_date"),
            F.lit(None).cast("date").alias("ship_date"), "error",
            F.lit("reject").alias("outcome")))
    )


def _ts_text() -> F.Column:
    et = F.col("event_type")
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    return (
        F.when(et == "click", F.concat(F.date_format("ts", iso), F.lit("Z")))
        .when(et == "view", F.concat(
            F.date_format(F.col("ts") + F.expr("INTERVAL 330 MINUTES"), iso), F.lit("+05:30")))
        .when(et == "purchase", F.date_format("ts", "yyyy-MM-dd"))
        .when(et == "signup", F.date_format("ts", "yyyyMMdd'T'HHmmss"))
        .when(F.col("value") < 100, F.date_format("ts", "HH:mm:ss"))
        .when(F.col("value") < 200, F.concat(  # an offset with seconds
            F.date_format(F.col("ts") + F.expr("INTERVAL 19815 SECONDS"), iso), F.lit("+05:30:15")))
        .when(F.col("value") < 300, F.date_format("ts", "yyyy-MM-dd'_'HH:mm:ss"))
        .when(F.col("value") < 400, F.concat(  # a week date
            F.date_format("ts", "yyyy"), F.lit("-W"), F.lpad(F.weekofyear("ts").cast("string"), 2, "0"), F.lit("-"),
            (F.weekday("ts") + 1).cast("string")))
        .otherwise(F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC")))
    )


def q_safe_timestamp(spark, sf):
    ev = _events(spark, sf)
    t = ev.select("event_id", _ts_text().alias("ts_text"))
    return fx.as_ntz(t.withColumn("parsed", safe_timestamp("ts_text")))


def q_partition_date(spark, sf):
    ev = _events(spark, sf).select("event_id", "event_type", "ts")
    src = ev.withColumn("path", fx.event_source_file())
    out = with_provenance(src, None).withColumn("ingestion_timestamp", F.col("ts").cast("timestamp"))
    out = with_partition_date(out)
    return fx.as_ntz(out.select("event_id", "source_file", "ingestion_timestamp", "p_date"))


def q_canonical_json(spark, sf):
    ev = _events(spark, sf)
    return ev.select("event_id", canonical_json("props").alias("canonical"))


def q_json_value(spark, sf):
    ev = _events(spark, sf)
    return ev.select("event_id", json_value("props", "$.k").alias("k"))


def q_wrap_payload(spark, sf):
    ev = _events(spark, sf)
    recs = ev.select(
        fx.event_source_file().alias("path"),
        F.col("ts").cast("timestamp").alias("modificationTime"),
        F.to_json(F.struct(*fx.record_text_columns())).alias("record_json"),
    )
    out = wrap_payload(recs).select("path", "payload", "_partition_date")
    return out


# -- object fixtures: events written as .json.gz, read back --------------------
FAR_PAST = "2000-01-01T00:00:00Z"
EXEC_DATE = "2024-01-30T12:00:00Z"


def _objects(spark, sf, name, layouts=None, default=fx.GOOD_NDJSON, folder="Order_Events"):
    """Read-only .json.gz objects derived from ``events`` (shared per process)."""
    root, _ = fx.event_objects(_events(spark, sf), sf, layouts, default, folder)
    return root


def _decoded(spark, root, folder="Order_Events"):
    return decode_listing(list_changed(spark, root, folder, FAR_PAST), root)


def _typed_from_objects(spark, root):
    dec = _decoded(spark, root)
    rows, _bad, _ = shape_folder(dec, OE, fx.NOW, cache=False)
    return rows


def _decode_query(layout):
    def q(spark, sf):
        root = _objects(spark, sf, f"decode-{layout}", default=layout)
        return fx.as_ntz(_typed_from_objects(spark, root).select(*OE.business_columns))
    return q


def _bad_files(spark, sf):
    root = _objects(spark, sf, "decode-bad", layouts=fx.BAD_FILE_LAYOUT)
    return root, _decoded(spark, root).withColumn("name", relative_name("path", root))


def q_decode_bad_files(spark, sf):
    _, dec = _bad_files(spark, sf)
    return dec.groupBy("name").agg(
        F.count("record_json").alias("n_records"),
        F.max(F.substring_index("error", ":", 1)).alias("error_kind"),
    )


def q_decode_odd_objects(spark, sf):
    """Records and error of every object, those without any included."""
    root = _objects(spark, sf, "decode-odd", layouts=fx.ODD_FILE_LAYOUT)
    objs = list_changed(spark, root, OE.folder, FAR_PAST)
    found = decode_listing(objs, root).groupBy("path").agg(
        F.count("record_json").alias("n"), F.max(F.substring_index("error", ":", 1)).alias("error_kind"))
    return objs.select("path", "name").join(found, "path", "left").select(
        "name", F.coalesce("n", F.lit(0)).alias("n_records"), "error_kind")


def q_list_changed_objects(spark, sf):
    """S3 by tasks: names of all objects, and none at a cutoff in the future."""
    root = _objects(spark, sf, "objects")
    late = list_changed(spark, root, OE.folder, "2100-01-01T00:00:00Z")
    return list_changed(spark, root, OE.folder, FAR_PAST).unionByName(late).select("name", (F.col("length") > 0).alias("has_bytes"))


def _spelt_numbers(ev: DataFrame) -> DataFrame:
    """The same event ids, each in several spellings of one value."""
    i = F.col("event_id").cast("string")
    spelt = F.when(F.col("event_type") == "click", F.concat(i, F.lit("e2"))) \
        .when(F.col("event_type") == "view", F.concat(i, F.lit(".50e1"))) \
        .when(F.col("event_type") == "purchase", F.concat(i, F.lit("E+400"))) \
        .when(F.col("event_type") == "signup", F.concat(F.lit("9007199254740993"), i, F.lit("e0"))) \
        .otherwise(F.concat(F.lit("-"), i, F.lit(".0e-400")))
    text = F.concat(F.lit('{"z": '), spelt, F.lit(', "a": ['), spelt, F.lit(', "5e3 x, 1E2", true], "id": '), i, F.lit(".0}"))
    return ev.select("event_id", "ts", text.alias("record_json"))


def q_canonical_json_numbers(spark, sf):
    """Numbers in their exact normal form, whatever their size and spelling."""
    return _spelt_numbers(_events(spark, sf)).select("event_id", canonical_json("record_json").alias("canonical"))


def q_payload_identity_numbers(spark, sf):
    """Payloads that differ beyond a double's digits stay apart, other
    spellings of one value are one payload. Gold has the even ids' payloads."""
    ev = _events(spark, sf).select("event_id", F.col("ts").cast("timestamp").alias(INGESTION_TS))
    number = F.concat(F.lit("9007199254740993"), F.col("event_id").cast("string"))
    spelt = F.explode(F.array(F.concat(number, F.lit("e0")), F.concat(number, F.lit(".0")), F.concat(number, F.lit("0e-1")))).alias("n")
    rows = ev.select("event_id", INGESTION_TS, spelt).select(
        "event_id", F.concat(F.lit('{"v":'), F.col("n"), F.lit("}")).alias("record_json"), F.lit("f").alias("source_file"), INGESTION_TS)
    shaped = wrap_payload(rows, "record_json", None)
    gold = shaped.where("event_id % 2 = 0").select(*PAY.row_columns).withColumn("_identity", F.col("payload"))
    stage = shaped.select(*PAY.row_columns).withColumn("_identity", F.col("payload"))
    fresh = merge_insert_only(gold, latest_for_spec(stage, PAY), "_identity", PAY.row_columns, fx.NOW, LAST_UPDATED, strategy="auto")
    return fx.as_ntz(fresh.select("payload", INGESTION_TS))


def q_refused_records(spark, sf):
    """Records that the parser refuses come back whole from their letters."""
    ev = _events(spark, sf)
    i = F.col("event_id").cast("string")
    deep = F.when(F.col("event_type") == "error", F.concat(
        F.lit('{"order_ref":"'), i, F.lit('","deep":'), F.repeat(F.lit("["), 1200), i, F.repeat(F.lit("]"), 1200), F.lit("}")))
    recs = ev.select(F.lit(OE.folder).alias("folder"), fx.event_source_file().alias("path"), F.lit(None).cast("string").alias("error"),
                     F.coalesce(deep, F.to_json(F.struct(*fx.record_text_columns()))).alias("record_json"))
    rows, bad, _ = shape_folder(recs, OE, fx.NOW, cache=False)
    letters = row_dead_letters(bad, OE.stage_table, [*OE.business_columns, REFUSED_RECORD, "source_file"], SOURCE_STREAM, fx.NOW)
    return letters.select(
        F.get_json_object("data", "$.row.source_file").alias("source_file"), F.get_json_object("data", "$.error").alias("error"),
        F.sha2(F.get_json_object("data", f"$.row.{REFUSED_RECORD}"), 256).alias("record_sha256")) \
        .unionByName(rows.select("source_file", F.lit(None).cast("string").alias("error"), F.lit(None).cast("string").alias("record_sha256")))


#: L4: a folder of its own key and columns.
RETURNS = FolderSpec(folder="Returns", stage_table="STG_Returns", gold_table="Returns", key="return_id",
                     columns=(("return_id", "STRING"), ("returned_at", "TIMESTAMP"), ("return_day", "DATE"), ("reason", "STRING")))


def q_onboard_folder(spark, sf):
    """L4: a third folder is registered and goes through objects, stage, merge
    and view; nothing but its spec is new."""
    ev = _events(spark, sf)
    base = work_dir(spark, "onboard")
    records = ev.select(
        F.concat(F.lit(f"{RETURNS.folder}/"), F.col("event_type"), F.lit("/u"), F.col("user_id").cast("string"), F.lit(".json.gz")).alias("name"),
        "event_type", "event_id", F.to_json(F.struct(
            (F.col("event_id") % 1000).cast("string").alias("return_id"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("returned_at"),
            F.when(F.col("event_type") == "error", F.lit("soon")).otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("return_day"),
            F.lpad(F.col("event_id").cast("string"), 12, "0").alias("reason"))).alias("record_json"))
    fx.write_objects(records, base)
    reg = default_registry()
    reg.register(RETURNS)
    cfg = PipelineConfig(lake_root=f"{base}/lake", objects_root=base, registry=reg)
    daily_reprocess(spark, cfg, EXEC_DATE, now=fx.NOW, as_of=fx.AS_OF)
    view = unified_view(RETURNS, cfg.gold(RETURNS).read(spark), cfg.stage(RETURNS).read(spark), fx.AS_OF)
    letters = read_dead_letters(spark, cfg.dead_letters).where(F.contains("attributes", F.lit(RETURNS.stage_table)))
    return fx.as_ntz(view.select(F.lit("view").alias("part"), "return_id", "returned_at", F.col("return_day").cast("string").alias("return_day"), "reason")
                     .unionByName(letters.select(
                         F.lit("letter").alias("part"), F.get_json_object("data", "$.row.return_id").alias("return_id"),
                         F.to_timestamp(F.get_json_object("data", "$.row.returned_at")).alias("returned_at"),
                         F.get_json_object("data", "$.row.return_day").alias("return_day"), F.get_json_object("data", "$.row.reason").alias("reason"))))


def q_merge_upsert_bucketed(spark, sf):
    """M1 with gold as a catalog table bucketed and sorted by its key."""
    gold, stage = fx.explicit_layers(_events(spark, sf))
    table = f"gold_{uuid.uuid4().hex[:12]}"
    write_bucketed(gold, table, OE.key, work_dir(spark, "bucketed"))
    src = _merge_source(stage, OE.hourly_days)
    return fx.as_ntz(merge_upsert(spark.table(table), src, OE.key, OE.order_col, OE.row_columns, "shuffle"))


def q_file_dead_letters(spark, sf):
    _, dec = _bad_files(spark, sf)
    errors = dec.filter(F.col("error").isNotNull()).select(
        F.lit(OE.stage_table).alias("table"), F.col("name").alias("source_file"), "error")
    dl = file_dead_letters(errors, SOURCE_BATCH, fx.NOW)
    return fx.as_ntz(dl.select(
        "subscription_name", "publish_time", "attributes",
        F.get_json_object("data", "$.source_file").alias("source_file"),
        F.substring_index(F.get_json_object("data", "$.error"), ":", 1).alias("error_kind")))


def _row_dead_letters(spark, sf):
    _, bad = split_rejects(_raw_dates(_events(spark, sf)), OE)
    return row_dead_letters(bad, OE.stage_table, ["order_ref", "order_date", "ship_date"],
                            SOURCE_STREAM, fx.NOW)


def q_row_dead_letters(spark, sf):
    return fx.as_ntz(_row_dead_letters(spark, sf))


def q_fanout_dead_letters(spark, sf):
    root = _objects(spark, sf, "fanout")
    dec = _decoded(spark, root)
    files = dec.filter(F.col("error").isNull()).select(
        relative_name("path", root).alias("source_file"))
    return fx.as_ntz(fanout_dead_letters(files, OE.stage_table, "stage append failed",
                                         SOURCE_BATCH, fx.NOW))


def _notifications(ev: DataFrame) -> DataFrame:
    folder = F.when(F.col("event_type") == "signup", F.lit("Other")).otherwise(F.lit("Order_Events"))
    suffix = F.when(F.col("value") < 10, F.lit(".csv")).otherwise(F.lit(".json.gz"))
    name = F.concat(folder, F.lit("/"), F.col("event_type"), F.lit("/"),
                    F.col("event_id").cast("string"), suffix)
    bucket = F.when(F.col("value") >= 480, F.lit(None)).when(F.col("value") >= 470, F.lit("")) \
        .otherwise(F.lit("lake-bucket"))
    event = F.when(F.col("event_type") == "error", F.lit("OBJECT_DELETE")) \
        .otherwise(F.lit("OBJECT_FINALIZE"))
    attrs = F.map_filter(
        F.create_map(F.lit("eventType"), event, F.lit("objectId"), name,
                     F.lit("bucketId"), bucket),
        lambda k, v: v.isNotNull())
    return ev.select(F.col("event_id").cast("string").alias("message_id"),
                     F.col("ts").cast("timestamp").alias("publish_time"),
                     attrs.alias("attributes"), F.lit(None).cast("string").alias("data"))


def q_extract_object_path(spark, sf):
    ext = extract_object_path(_notifications(_events(spark, sf)))
    return ext.select("message_id", "tag", "bucket", "name", "source_file", "table", "error")


def q_route_by_folder(spark, sf):
    ext = extract_object_path(_notifications(_events(spark, sf)))
    objs = ext.filter(F.col("tag") == TAG_OBJECT)
    routed = route_by_folder(objs, default_registry())
    return routed.select("message_id", "name", "folder", "tag", "table", "error")


def q_union_dead_letters(spark, sf):
    ext = extract_object_path(_notifications(_events(spark, sf)))
    msgs = file_dead_letters(ext.filter(F.col("tag") == TAG_DEAD)
                             .select("table", "source_file", "error"), SOURCE_STREAM, fx.NOW)
    rows = _row_dead_letters(spark, sf)
    dl = union_dead_letters(msgs, rows)
    return dl.select(
        "attributes",
        F.coalesce(F.get_json_object("data", "$.source_file"),
                   F.get_json_object("data", "$.row.order_ref")).alias("ref"),
        F.get_json_object("data", "$.error").alias("error"))


def q_list_objects_cutoff(spark, sf):
    ev = _events(spark, sf)
    listing = _notifications(ev).select(
        F.col("attributes")["objectId"].alias("name"),
        F.col("publish_time").alias("modificationTime"))
    return fx.as_ntz(filter_listing(listing, OE.folder, lookback_cutoff(EXEC_DATE)))


def _lake(spark, name, objects_root=None):
    base = work_dir(spark, name)
    return PipelineConfig(lake_root=f"{base}/lake", objects_root=objects_root or f"{base}/objects",
                          registry=default_registry())


def q_append_stage(spark, sf):
    cfg = _lake(spark, "append")
    _, stage = fx.explicit_layers(_events(spark, sf))
    store = cfg.stage(OE)
    store.append(stage, "b1")
    store.append(stage, "b1")  # replayed batch: replaces, never duplicates
    return fx.as_ntz(store.read(spark, fx.AS_OF))


def q_expire_partitions(spark, sf):
    cfg = _lake(spark, "expire")
    _, stage = fx.explicit_layers(_events(spark, sf))
    store = cfg.stage(OE)
    store.append(stage, "b1")
    store.expire(spark, fx.AS_OF)
    return fx.as_ntz(store.read(spark, as_of=None))


def _seed_lake(spark, sf, name):
    cfg = _lake(spark, name)
    ev = _events(spark, sf)
    gold, stage = fx.explicit_layers(ev)
    cfg.gold(OE).commit(spark, gold)
    cfg.stage(OE).append(stage, "seed")
    pgold, pstage = fx.payload_layers(ev)
    cfg.gold(PAY).commit(spark, pgold)
    cfg.stage(PAY).append(pstage, "seed")
    return cfg


def q_hourly_merge(spark, sf):
    cfg = _seed_lake(spark, sf, "hourly")
    hourly_merge(spark, cfg, fx.AS_OF, fx.NOW)
    return fx.as_ntz(cfg.gold(OE).read(spark))


def q_hourly_merge_payload(spark, sf):
    cfg = _seed_lake(spark, sf, "hourly-payload")
    hourly_merge(spark, cfg, fx.AS_OF, fx.NOW)
    return fx.as_ntz(cfg.gold(PAY).read(spark))


def _daily_output(cfg, spark):
    g = cfg.gold(OE).read(spark)
    return fx.as_ntz(g.select(*OE.business_columns, "ingestion_timestamp"))


def q_daily_reprocess(spark, sf):
    cfg = _lake(spark, "daily", _objects(spark, sf, "objects"))
    gold, _ = fx.explicit_layers(_events(spark, sf))
    cfg.gold(OE).commit(spark, gold)
    daily_reprocess(spark, cfg, EXEC_DATE, now=fx.NOW, as_of=fx.AS_OF)
    return _daily_output(cfg, spark)


def q_merge_null_keys(spark, sf):
    """Every stage row without a key is reported once, however often its window
    is merged."""
    cfg = _lake(spark, "null-keys")
    _, stage = fx.explicit_layers(_events(spark, sf))
    cfg.stage(OE).append(stage.withColumn("record_id", F.when(F.col("category") != "error", F.col("record_id"))), "seed")
    for _ in range(2):
        hourly_merge(spark, cfg, fx.AS_OF, fx.NOW)
    letters = read_dead_letters(spark, cfg.dead_letters)
    return letters.select("attributes", F.get_json_object("data", "$.row.order_ref").alias("order_ref"),
                          F.get_json_object("data", "$.error").alias("error"))


def q_dead_letter_table(spark, sf):
    """The dead-letter table after a stream and a daily re-read of bad objects
    and a folder that nobody registered."""
    ev = _events(spark, sf)
    root = work_dir(spark, "dead-objects")
    for folder in (OE.folder, "Other"):
        fx.write_event_objects(ev, root, fx.BAD_FILE_LAYOUT, folder=folder)
    cfg = _lake(spark, "dead-letters", root)
    stream_ingest(spark, cfg, f"{cfg.lake_root}/_checkpoints/ingest", available_now=True,
                  now_fn=lambda: fx.NOW.replace(tzinfo=dt.timezone.utc)).awaitTermination()
    daily_reprocess(spark, cfg, EXEC_DATE, now=fx.NOW, as_of=fx.AS_OF)
    letters = read_dead_letters(spark, cfg.dead_letters)
    return letters.select(
        "attributes", "publish_date",
        relative_name(F.get_json_object("data", "$.source_file"), root).alias("source_file"),
        F.substring_index(F.get_json_object("data", "$.error"), ":", 1).alias("error_kind"))


def q_daily_reprocess_payload(spark, sf):
    cfg = _lake(spark, "daily-payload", _objects(spark, sf, "objects", folder=PAY.folder))
    daily_reprocess(spark, cfg, EXEC_DATE, now=fx.NOW, as_of=fx.AS_OF)
    g = cfg.gold(PAY).read(spark)
    return fx.as_ntz(g.select("payload", "ingestion_timestamp", LAST_UPDATED))


def q_stream_ingest(spark, sf):
    cfg = _lake(spark, "stream", _objects(spark, sf, "objects"))
    ckpt = f"{cfg.lake_root}/_checkpoints/ingest"
    q = stream_ingest(spark, cfg, ckpt, available_now=True,
                      now_fn=lambda: fx.NOW.replace(tzinfo=dt.timezone.utc))
    q.awaitTermination()
    return fx.as_ntz(cfg.stage(OE).read(spark).select(*OE.business_columns))


def _scheme_and_bucket(root: str) -> tuple[str, str]:
    if "://" in root:
        scheme, rest = root.split("://", 1)
        return scheme, rest.rstrip("/")
    return "file", root.removeprefix("file:").rstrip("/")


def q_stream_ingest_notifications(spark, sf):
    root, written = fx.event_objects(_events(spark, sf), sf)
    cfg = _lake(spark, "stream-notif", root)
    scheme, bucket = _scheme_and_bucket(cfg.objects_root)
    # one finalize notification per object, plus one for an object that
    # was never written (read error -> dead letter, no rows)
    names = written.select("name").unionByName(written.select(
        F.regexp_replace("name", r"\.json\.gz$", ".missing.json.gz").alias("name")))
    notif = names.select(
        F.col("name").alias("message_id"),
        F.lit(fx.NOW).cast("timestamp").alias("publish_time"),
        F.create_map(F.lit("eventType"), F.lit("OBJECT_FINALIZE"), F.lit("objectId"), F.col("name"),
                     F.lit("bucketId"), F.lit(bucket)).alias("attributes"),
        F.lit(None).cast("string").alias("data"))
    notif_dir = f"{cfg.lake_root}/_notifications"
    notif.write.mode("overwrite").json(notif_dir)
    q = stream_ingest(spark, cfg, f"{cfg.lake_root}/_checkpoints/notif", source="notifications",
                      notifications_path=notif_dir, scheme=scheme, available_now=True,
                      now_fn=lambda: fx.NOW.replace(tzinfo=dt.timezone.utc))
    q.awaitTermination()
    return fx.as_ntz(cfg.stage(OE).read(spark).select(*OE.business_columns))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "latest_by_key_events": q_latest_by_key_events,
    "latest_by_key_lineitem": q_latest_by_key_lineitem,
    "stage_window_1d": _stage_window(1),
    "stage_window_2d": _stage_window(2),
    "union_layers": q_union_layers,
    "unified_view_explicit": q_unified_view_explicit,
    "unified_view_payload": q_unified_view_payload,
    "unified_view_explicit_broadcast": q_unified_view_explicit_broadcast,
    "unified_view_payload_broadcast": q_unified_view_payload_broadcast,
    "merge_upsert_1d": _merge_upsert(1, "shuffle"),
    "merge_upsert_2d": _merge_upsert(2, "auto"),
    "merge_actions": q_merge_actions,
    "merge_idempotent": q_merge_idempotent,
    "merge_insert_only": q_merge_insert_only,
    "key_gate": q_key_gate,
    "split_rejects": q_split_rejects,
    "safe_timestamp": q_safe_timestamp,
    "partition_date": q_partition_date,
    "canonical_json": q_canonical_json,
    "json_value": q_json_value,
    "wrap_payload": q_wrap_payload,
    "decode_ndjson": _decode_query(fx.GOOD_NDJSON),
    "decode_json_array": _decode_query(fx.GOOD_ARRAY),
    "decode_bad_files": q_decode_bad_files,
    "decode_odd_objects": q_decode_odd_objects,
    "list_changed_objects": q_list_changed_objects,
    "canonical_json_numbers": q_canonical_json_numbers,
    "payload_identity_numbers": q_payload_identity_numbers,
    "refused_records": q_refused_records,
    "onboard_folder": q_onboard_folder,
    "merge_upsert_bucketed": q_merge_upsert_bucketed,
    "file_dead_letters": q_file_dead_letters,
    "row_dead_letters": q_row_dead_letters,
    "fanout_dead_letters": q_fanout_dead_letters,
    "union_dead_letters": q_union_dead_letters,
    "extract_object_path": q_extract_object_path,
    "route_by_folder": q_route_by_folder,
    "list_objects_cutoff": q_list_objects_cutoff,
    "append_stage": q_append_stage,
    "expire_partitions": q_expire_partitions,
    "hourly_merge": q_hourly_merge,
    "merge_null_keys": q_merge_null_keys,
    "dead_letter_table": q_dead_letter_table,
    "hourly_merge_payload": q_hourly_merge_payload,
    "daily_reprocess": q_daily_reprocess,
    "daily_reprocess_payload": q_daily_reprocess_payload,
    "stream_ingest": q_stream_ingest,
    "stream_ingest_notifications": q_stream_ingest_notifications,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: hourly merge of the Order_Events stage into gold (sf0.001)."""
    return QUERIES["merge_upsert_1d"](spark, SF_SMOKE)


# The training-data operators are an optional subpackage: present or absent as
# a whole. An error inside it is not hidden.
_LLM = importlib.util.find_spec("tidemark.llm") is not None
if _LLM:
    try:
        import corpus_pipeline
        from tidemark.llm import queries as llm_queries
    except ImportError as exc:  # a library that only this subpackage needs isn't there
        if (exc.name or "tidemark").split(".")[0] in ("tidemark", "corpus_pipeline"):
            raise
        _LLM = False
        logging.getLogger(__name__).warning("training-data queries left out: %s", exc)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return QUERIES | (llm_queries.QUERIES | {"pipeline": corpus_pipeline.run} if _LLM else {})


# ---------------------------------------------------------------------------
# DuckDB oracle
# ---------------------------------------------------------------------------
_ROW_COLS = ", ".join(OE.row_columns)
_BIZ_COLS = ", ".join(OE.business_columns)


def _order_sql(spec) -> str:
    keys = [spec.order_col] + tie_breakers(spec)
    return ", ".join(f"{c} DESC NULLS LAST" for c in keys)


_EV_ROWS = """
ev_rows AS (
  SELECT CAST(user_id AS VARCHAR) AS record_id,
         CAST(ts AS DATE) AS order_date,
         CAST(ts AS DATE) + 2 AS ship_date,
         CAST(event_id AS VARCHAR) AS order_ref,
         props AS source_code,
         event_type AS category,
         CASE WHEN value >= 100 THEN 'high' ELSE 'low' END AS status,
         CASE WHEN event_type IN ('click', 'view') THEN 'web' ELSE 'app' END AS channel,
         ts AS event_timestamp,
         'user-' || CAST(user_id AS VARCHAR) AS customer_name,
         CASE WHEN event_type <> 'error' THEN upper(substr(event_type, 1, 2)) END AS region_code,
         'user' || CAST(user_id AS VARCHAR) || '@example.com' AS contact_email,
         'events/' || event_type || '/' || CAST(event_id AS VARCHAR) || '.json.gz' AS source_file,
         ts AS ingestion_timestamp,
         CAST(ts AS DATE) AS p_date,
         event_type, value
  FROM events
)"""

_LAYERS = _EV_ROWS + f""",
gold_pre AS (
  SELECT {_ROW_COLS} FROM (
    SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY {_order_sql(OE)}) AS _rn
    FROM ev_rows WHERE event_type IN ('purchase', 'view') AND value >= 150)
  WHERE _rn = 1
),
stage AS (
  SELECT {_ROW_COLS}, p_date FROM ev_rows
  WHERE NOT coalesce(event_type IN ('purchase', 'view') AND value >= 150, false)
)"""


def _since(days: int, col: str = "p_date") -> str:
    return f"{col} >= CAST(DATE '2024-01-30' - INTERVAL {days} DAY AS DATE)"


def _merge_src_sql(days: int) -> str:
    return f"""src AS (
  SELECT {_ROW_COLS} FROM (
    SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY {_order_sql(OE)}) AS _rn
    FROM stage WHERE {_since(days)})
  WHERE _rn = 1 AND record_id IS NOT NULL
)"""


def _merge_sql(days: int) -> str:
    pick = ",\n  ".join(
        f"CASE WHEN T.record_id IS NULL OR S.ingestion_timestamp > T.ingestion_timestamp "
        f"THEN S.{c} ELSE T.{c} END AS {c}" for c in OE.row_columns)
    return f"""WITH {_LAYERS},
{_merge_src_sql(days)}
SELECT
  {pick}
FROM gold_pre T FULL OUTER JOIN src S ON T.record_id = S.record_id"""


_PAY_ROWS = """
pay_rows AS (
  SELECT CAST(json(props) AS VARCHAR) AS payload,
         'events/' || event_type || '/' || CAST(event_id AS VARCHAR) || '.json.gz' AS source_file,
         ts AS ingestion_timestamp,
         CAST(ts AS DATE) AS _partition_date,
         event_type, value
  FROM events
),
pay_gold AS (
  SELECT payload, source_file, ingestion_timestamp, ingestion_timestamp AS _last_updated FROM (
    SELECT *, row_number() OVER (PARTITION BY payload ORDER BY ingestion_timestamp DESC NULLS LAST,
                                 source_file DESC NULLS LAST, payload DESC NULLS LAST) AS _rn
    FROM pay_rows WHERE event_type IN ('purchase', 'view') AND value >= 150)
  WHERE _rn = 1
),
pay_stage AS (
  SELECT payload, source_file, ingestion_timestamp, _partition_date
  FROM pay_rows
  WHERE NOT coalesce(event_type IN ('purchase', 'view') AND value >= 150, false)
)"""

_TS_TEXT = """CASE
    WHEN event_type = 'click' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z'
    WHEN event_type = 'view' THEN strftime(ts + INTERVAL 330 MINUTE, '%Y-%m-%dT%H:%M:%S.%f') || '+05:30'
    WHEN event_type = 'purchase' THEN strftime(ts, '%Y-%m-%d')
    WHEN event_type = 'signup' THEN strftime(ts, '%Y%m%dT%H%M%S')
    WHEN value < 100 THEN strftime(ts, '%H:%M:%S')
    WHEN value < 200 THEN strftime(ts + INTERVAL 19815 SECOND, '%Y-%m-%dT%H:%M:%S.%f') || '+05:30:15'
    WHEN value < 300 THEN strftime(ts, '%Y-%m-%d_%H:%M:%S')
    WHEN value < 400 THEN strftime(ts, '%Y-W%V-%u')
    ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') || ' UTC' END"""

_RAW_DATES = """raw AS (
  SELECT CAST(event_id AS VARCHAR) AS order_ref,
         CASE WHEN event_type = 'error' THEN 'not-a-date' ELSE strftime(ts, '%Y-%m-%d') END AS order_date,
         CASE WHEN value < 5 THEN '2024-02-30'
              WHEN event_type = 'signup' THEN ''
              ELSE strftime(CAST(ts AS DATE) + 2, '%Y-%m-%d') END AS ship_date
  FROM events
),
checked AS (
  SELECT order_ref, TRY_CAST(order_date AS DATE) AS od, TRY_CAST(ship_date AS DATE) AS sd,
         concat_ws('; ',
           CASE WHEN coalesce(order_date, '') <> '' AND TRY_CAST(order_date AS DATE) IS NULL
                THEN 'invalid DATE for order_date: ''' || order_date || '''' END,
           CASE WHEN coalesce(ship_date, '') <> '' AND TRY_CAST(ship_date AS DATE) IS NULL
                THEN 'invalid DATE for ship_date: ''' || ship_date || '''' END) AS err
  FROM raw
)"""

_RECORD_JSON = """CASE WHEN event_type <> 'error' THEN
      json_object('category', event_type,
                  'channel', CASE WHEN event_type IN ('click', 'view') THEN 'web' ELSE 'app' END,
                  'contact_email', 'user' || CAST(user_id AS VARCHAR) || '@example.com',
                  'customer_name', 'user-' || CAST(user_id AS VARCHAR),
                  'event_timestamp', strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z',
                  'order_date', strftime(ts, '%Y-%m-%d'),
                  'order_ref', CAST(event_id AS VARCHAR),
                  'record_id', CAST(user_id AS VARCHAR),
                  'region_code', upper(substr(event_type, 1, 2)),
                  'ship_date', strftime(CAST(ts AS DATE) + 2, '%Y-%m-%d'),
                  'source_code', props,
                  'status', CASE WHEN value >= 100 THEN 'high' ELSE 'low' END)
    ELSE
      json_object('category', event_type,
                  'channel', CASE WHEN event_type IN ('click', 'view') THEN 'web' ELSE 'app' END,
                  'contact_email', 'user' || CAST(user_id AS VARCHAR) || '@example.com',
                  'customer_name', 'user-' || CAST(user_id AS VARCHAR),
                  'event_timestamp', strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z',
                  'order_date', strftime(ts, '%Y-%m-%d'),
                  'order_ref', CAST(event_id AS VARCHAR),
                  'record_id', CAST(user_id AS VARCHAR),
                  'ship_date', strftime(CAST(ts AS DATE) + 2, '%Y-%m-%d'),
                  'source_code', props,
                  'status', CASE WHEN value >= 100 THEN 'high' ELSE 'low' END)
    END"""


def _sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["latest_by_key_events"] = """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id
                               ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) AS _rn
  FROM events) WHERE _rn = 1"""
    q["latest_by_key_lineitem"] = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
       l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey
      ORDER BY l_shipdate DESC NULLS LAST, l_linenumber DESC NULLS LAST,
               l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST) AS _rn
  FROM lineitem) WHERE _rn = 1"""
    for d in (1, 2):
        q[f"stage_window_{d}d"] = f"WITH {_LAYERS}\nSELECT {_ROW_COLS}, p_date FROM stage WHERE {_since(d)}"
    q["union_layers"] = f"""WITH {_LAYERS}
SELECT {_ROW_COLS} FROM gold_pre
UNION ALL
SELECT {_ROW_COLS} FROM stage WHERE {_since(2)}"""
    q["unified_view_explicit"] = f"""WITH {_LAYERS},
combined AS (
  SELECT {_ROW_COLS} FROM gold_pre
  UNION ALL
  SELECT {_ROW_COLS} FROM stage WHERE {_since(2)}
)
SELECT {_BIZ_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY {_order_sql(OE)}) AS _rn
  FROM combined) WHERE _rn = 1"""
    q["unified_view_payload"] = f"""WITH {_PAY_ROWS},
combined AS (
  SELECT payload, source_file, ingestion_timestamp FROM pay_gold
  UNION ALL
  SELECT payload, source_file, ingestion_timestamp FROM pay_stage WHERE {_since(1, '_partition_date')}
)
SELECT payload, source_file, ingestion_timestamp FROM (
  SELECT *, row_number() OVER (PARTITION BY payload ORDER BY ingestion_timestamp DESC NULLS LAST,
                               source_file DESC NULLS LAST, payload DESC NULLS LAST) AS _rn
  FROM combined) WHERE _rn = 1"""
    q["unified_view_explicit_broadcast"] = q["unified_view_explicit"]
    q["unified_view_payload_broadcast"] = q["unified_view_payload"]
    q["merge_upsert_1d"] = _merge_sql(1)
    q["merge_upsert_2d"] = _merge_sql(2)
    q["merge_idempotent"] = _merge_sql(1)
    q["merge_actions"] = f"""WITH {_LAYERS},
{_merge_src_sql(1)}
SELECT CASE WHEN T.record_id IS NULL THEN 'insert'
            WHEN S.record_id IS NULL THEN 'gold_only'
            WHEN S.ingestion_timestamp > T.ingestion_timestamp THEN 'update'
            ELSE 'matched_not_newer' END AS action,
       count(*) AS n
FROM gold_pre T FULL OUTER JOIN src S ON T.record_id = S.record_id
GROUP BY 1"""
    q["merge_insert_only"] = f"""WITH {_PAY_ROWS},
src AS (
  SELECT payload, source_file, ingestion_timestamp FROM (
    SELECT *, row_number() OVER (PARTITION BY payload ORDER BY ingestion_timestamp DESC NULLS LAST,
                                 source_file DESC NULLS LAST, payload DESC NULLS LAST) AS _rn
    FROM pay_stage WHERE {_since(1, '_partition_date')})
  WHERE _rn = 1
)
SELECT payload, source_file, ingestion_timestamp, _last_updated FROM pay_gold
UNION ALL
SELECT payload, source_file, ingestion_timestamp, TIMESTAMP '2024-01-31 12:00:00' AS _last_updated
FROM src WHERE payload NOT IN (SELECT payload FROM pay_gold)"""
    q["key_gate"] = """
SELECT CAST(NULLIF(user_id, 0) AS VARCHAR) AS record_id, CAST(event_id AS VARCHAR) AS order_ref,
       CASE WHEN NULLIF(user_id, 0) IS NULL THEN 'reject' ELSE 'pass' END AS gate,
       CASE WHEN NULLIF(user_id, 0) IS NULL THEN 'missing key: record_id is NULL' END AS error
FROM events"""
    q["split_rejects"] = f"""WITH {_RAW_DATES}
SELECT order_ref,
       CASE WHEN err = '' THEN od END AS order_date,
       CASE WHEN err = '' THEN sd END AS ship_date,
       NULLIF(err, '') AS error,
       CASE WHEN err = '' THEN 'ok' ELSE 'reject' END AS outcome
FROM checked"""
    q["safe_timestamp"] = f"""
SELECT event_id, {_TS_TEXT} AS ts_text,
       CASE WHEN event_type IN ('click', 'view') THEN ts
            WHEN event_type = 'purchase' THEN date_trunc('day', ts)
            WHEN event_type = 'signup' THEN date_trunc('second', ts)
            WHEN value < 100 THEN NULL
            WHEN value < 200 THEN ts
            WHEN value < 300 THEN date_trunc('second', ts)
            WHEN value < 400 THEN date_trunc('day', ts)
       END AS parsed
FROM events"""
    q["partition_date"] = """
SELECT event_id, 'events/' || event_type || '/' || CAST(event_id AS VARCHAR) || '.json.gz' AS source_file,
       ts AS ingestion_timestamp, CAST(ts AS DATE) AS p_date FROM events"""
    q["canonical_json"] = """
SELECT event_id, CAST(json(props) AS VARCHAR) AS canonical FROM events"""
    q["json_value"] = """
SELECT event_id, json_extract_string(props, '$.k') AS k FROM events"""
    q["wrap_payload"] = f"""
SELECT 'events/' || event_type || '/' || CAST(event_id AS VARCHAR) || '.json.gz' AS path,
       CAST({_RECORD_JSON} AS VARCHAR) AS payload,
       CAST(ts AS DATE) AS _partition_date
FROM events"""
    obj_name = "'Order_Events/' || event_type || '/u' || CAST(user_id AS VARCHAR) || '.json.gz'"
    q["decode_ndjson"] = f"WITH {_EV_ROWS}\nSELECT {_BIZ_COLS} FROM ev_rows"
    q["decode_json_array"] = q["decode_ndjson"]
    q["stream_ingest"] = q["decode_ndjson"]
    q["stream_ingest_notifications"] = q["decode_ndjson"]
    q["decode_bad_files"] = f"""
SELECT {obj_name} AS name,
       CASE WHEN event_type IN ('click', 'view') THEN count(*) ELSE 0 END AS n_records,
       CASE event_type WHEN 'error' THEN 'json' WHEN 'signup' THEN 'gzip'
                       WHEN 'purchase' THEN 'json' END AS error_kind
FROM events GROUP BY event_type, user_id"""
    q["decode_odd_objects"] = f"""
SELECT {obj_name} AS name, CASE WHEN event_type = 'purchase' THEN count(*) ELSE 0 END AS n_records,
       CASE WHEN event_type IN ('error', 'signup') THEN 'not_object' END AS error_kind
FROM events GROUP BY event_type, user_id"""
    q["list_changed_objects"] = f"SELECT DISTINCT {obj_name} AS name, true AS has_bytes FROM events"
    q["canonical_json_numbers"] = """WITH spelt AS (
  SELECT event_id, CAST(event_id AS VARCHAR) AS i, rtrim(CAST(event_id AS VARCHAR), '0') AS d, event_type FROM events),
numbers AS (
  SELECT event_id, i, CASE
    WHEN event_type = 'click' THEN CAST(event_id * 100 AS VARCHAR)
    WHEN event_type = 'view' THEN CAST(event_id * 10 + 5 AS VARCHAR)
    WHEN event_type = 'signup' THEN '9007199254740993' || i
    WHEN event_id = 0 THEN '0'
    WHEN event_type = 'purchase' THEN d[1] || CASE WHEN length(d) > 1 THEN '.' || d[2:] ELSE '' END || 'e' || CAST(length(i) - 1 + 400 AS VARCHAR)
    ELSE '-' || d[1] || CASE WHEN length(d) > 1 THEN '.' || d[2:] ELSE '' END || 'e' || CAST(length(i) - 1 - 400 AS VARCHAR) END AS n
  FROM spelt)
SELECT event_id, '{"a":[' || n || ',"5e3 x, 1E2",true],"id":' || i || ',"z":' || n || '}' AS canonical FROM numbers"""
    q["payload_identity_numbers"] = """
SELECT '{"v":9007199254740993' || CAST(event_id AS VARCHAR) || '}' AS payload, ts AS ingestion_timestamp FROM events WHERE event_id % 2 = 1"""
    q["refused_records"] = """WITH rows_in AS (
  SELECT 'events/' || event_type || '/' || CAST(event_id AS VARCHAR) || '.json.gz' AS source_file, event_type, CAST(event_id AS VARCHAR) AS i FROM events)
SELECT source_file, CASE WHEN event_type = 'error' THEN 'unreadable record' END AS error,
       CASE WHEN event_type = 'error' THEN
         sha256('{"order_ref":"' || i || '","deep":' || repeat('[', 1200) || i || repeat(']', 1200) || '}') END AS record_sha256
FROM rows_in"""
    q["onboard_folder"] = f"""WITH recs AS (
  SELECT CAST(event_id % 1000 AS VARCHAR) AS return_id, date_trunc('second', ts) AS returned_at, strftime(ts, '%Y-%m-%d') AS return_day,
         lpad(CAST(event_id AS VARCHAR), 12, '0') AS reason, event_type, {obj_name} AS name FROM events)
SELECT 'view' AS part, return_id, returned_at, return_day, reason FROM (
  SELECT *, row_number() OVER (PARTITION BY return_id ORDER BY name DESC, returned_at DESC, return_day DESC, reason DESC) AS _rn
  FROM recs WHERE event_type <> 'error') WHERE _rn = 1
UNION ALL
SELECT 'letter', return_id, returned_at, 'soon', reason FROM recs WHERE event_type = 'error'"""
    q["merge_upsert_bucketed"] = _merge_sql(1)
    q["file_dead_letters"] = f"""
SELECT 'deadletter' AS subscription_name, TIMESTAMP '2024-01-31 12:00:00' AS publish_time,
       '{{"source":"Airflow Daily Reprocessing","table":"STG_Order_Events"}}' AS attributes,
       {obj_name} AS source_file,
       CASE event_type WHEN 'signup' THEN 'gzip' ELSE 'json' END AS error_kind
FROM events WHERE event_type IN ('error', 'signup', 'purchase')
GROUP BY event_type, user_id"""
    q["row_dead_letters"] = f"""WITH {_RAW_DATES},
dl AS (
  SELECT '{{"source":"Dataflow Streaming","table":"STG_Order_Events"}}' AS attributes,
         CAST(json_object('row', json_object('order_ref', r.order_ref, 'order_date', r.order_date,
                                             'ship_date', r.ship_date),
                          'error', c.err) AS VARCHAR) AS data
  FROM raw r JOIN checked c ON r.order_ref = c.order_ref
  WHERE c.err <> ''
)
SELECT 'deadletter' AS subscription_name, sha256(attributes || chr(1) || data) AS message_id,
       TIMESTAMP '2024-01-31 12:00:00' AS publish_time, attributes, data
FROM dl"""
    q["fanout_dead_letters"] = f"""WITH dl AS (
  SELECT DISTINCT '{{"source":"Airflow Daily Reprocessing","table":"STG_Order_Events"}}' AS attributes,
         CAST(json_object('source_file', {obj_name}, 'error', 'stage append failed') AS VARCHAR) AS data
  FROM events
)
SELECT 'deadletter' AS subscription_name, sha256(attributes || chr(1) || data) AS message_id,
       TIMESTAMP '2024-01-31 12:00:00' AS publish_time, attributes, data
FROM dl"""
    notif = """notif AS (
  SELECT CAST(event_id AS VARCHAR) AS message_id, ts AS publish_time,
         CASE WHEN event_type = 'error' THEN 'OBJECT_DELETE' ELSE 'OBJECT_FINALIZE' END AS event_name,
         CASE WHEN event_type = 'signup' THEN 'Other' ELSE 'Order_Events' END || '/' || event_type
           || '/' || CAST(event_id AS VARCHAR)
           || CASE WHEN value < 10 THEN '.csv' ELSE '.json.gz' END AS name,
         CASE WHEN value >= 480 THEN NULL WHEN value >= 470 THEN '' ELSE 'lake-bucket' END AS bucket
  FROM events
),
notif_attrs AS (
  SELECT *, CAST(CASE WHEN bucket IS NULL
                      THEN json_object('eventType', event_name, 'objectId', name)
                      ELSE json_object('eventType', event_name, 'objectId', name, 'bucketId', bucket)
                 END AS VARCHAR) AS attrs_json
  FROM notif
),
extracted AS (
  SELECT message_id, name, bucket,
         CASE WHEN coalesce(bucket, '') = '' THEN 'dead_letter' ELSE 'gcs_path' END AS tag,
         CASE WHEN coalesce(bucket, '') = '' THEN 'unknown'
              ELSE 'gs://' || bucket || '/' || name END AS source_file,
         'unknown' AS "table",
         CASE WHEN coalesce(bucket, '') = ''
              THEN 'PubSub parse failure: Missing bucketId; attrs=' || attrs_json END AS error
  FROM notif_attrs
  WHERE event_name = 'OBJECT_FINALIZE' AND name LIKE '%.json.gz'
)"""
    q["extract_object_path"] = f"""WITH {notif}
SELECT message_id, tag, bucket, name, source_file, "table", error FROM extracted"""
    q["route_by_folder"] = f"""WITH {notif},
reg AS (
  SELECT * FROM (VALUES ('Order_Events', 'STG_Order_Events'),
                        ('Notification_Events', 'STG_Notification_Events')) AS t(folder, stage_table)
)
SELECT e.message_id, e.name, split_part(e.name, '/', 1) AS folder,
       CASE WHEN r.stage_table IS NULL THEN 'dead_letter' ELSE r.folder END AS tag,
       coalesce(r.stage_table, 'unknown') AS "table",
       CASE WHEN r.stage_table IS NULL
            THEN 'Unrecognised folder: ' || split_part(e.name, '/', 1) END AS error
FROM extracted e LEFT JOIN reg r ON split_part(e.name, '/', 1) = r.folder
WHERE e.tag = 'gcs_path'"""
    q["union_dead_letters"] = f"""WITH {notif}, {_RAW_DATES}
SELECT '{{"source":"Dataflow Streaming","table":"unknown"}}' AS attributes,
       source_file AS ref, error
FROM extracted WHERE tag = 'dead_letter'
UNION ALL
SELECT '{{"source":"Dataflow Streaming","table":"STG_Order_Events"}}' AS attributes,
       order_ref AS ref, err AS error
FROM checked WHERE err <> ''"""
    q["list_objects_cutoff"] = f"""WITH {notif}
SELECT name, publish_time AS modificationTime FROM notif
WHERE name LIKE 'Order_Events/%' AND name LIKE '%.json.gz'
  AND publish_time >= TIMESTAMP '2024-01-28 12:00:00'"""
    q["append_stage"] = f"""WITH {_LAYERS}
SELECT {_ROW_COLS}, p_date FROM stage WHERE p_date > DATE '2024-01-23'"""
    q["expire_partitions"] = q["append_stage"]
    q["hourly_merge"] = _merge_sql(1)
    q["hourly_merge_payload"] = q["merge_insert_only"]
    q["merge_null_keys"] = f"""WITH {_LAYERS}
SELECT '{{"source":"Airflow Daily Reprocessing","table":"{OE.gold_table}"}}' AS attributes, order_ref,
       'missing key: record_id is NULL' AS error
FROM stage WHERE category = 'error' AND {_since(1)}"""
    q["dead_letter_table"] = f"""WITH objects AS (
  SELECT DISTINCT event_type, event_type || '/u' || CAST(user_id AS VARCHAR) || '.json.gz' AS name,
         CASE event_type WHEN 'signup' THEN 'gzip' ELSE 'json' END AS kind FROM events),
bad AS (SELECT * FROM objects WHERE event_type IN ('error', 'signup', 'purchase'))
SELECT '{{"source":"' || source || '","table":"{OE.stage_table}"}}' AS attributes, DATE '2024-01-31' AS publish_date,
       '{OE.folder}/' || name AS source_file, kind AS error_kind
FROM bad, (VALUES ('Dataflow Streaming'), ('Airflow Daily Reprocessing')) t(source)
UNION ALL
SELECT '{{"source":"Dataflow Streaming","table":"unknown"}}', DATE '2024-01-31', 'Other/' || name, 'Unrecognised folder'
FROM objects"""
    daily_order = ", ".join(
        [f"{obj_name.replace('event_type', 'category').replace('CAST(user_id AS VARCHAR)', 'record_id')} DESC"]
        + [f"{c} DESC NULLS LAST" for c in tie_breakers(OE)[1:]])
    q["daily_reprocess"] = f"""WITH {_EV_ROWS}
SELECT {_BIZ_COLS}, TIMESTAMP '2024-01-31 12:00:00' AS ingestion_timestamp FROM (
  SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY {daily_order}) AS _rn
  FROM ev_rows) WHERE _rn = 1"""
    q["daily_reprocess_payload"] = f"""
SELECT CAST({_RECORD_JSON} AS VARCHAR) AS payload,
       TIMESTAMP '2024-01-31 12:00:00' AS ingestion_timestamp,
       TIMESTAMP '2024-01-31 12:00:00' AS _last_updated
FROM events"""
    return q


def oracle_sql() -> dict[str, str]:
    sql = _sql()
    sql = {k: v for k, v in sql.items() if k in QUERIES}
    return sql | (llm_queries.ORACLE_SQL if _LLM else {})

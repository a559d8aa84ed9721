"""Streaming ingest (L1, K1, S1/S2 → stage, failures → dead letter).

Stateless by design: no watermark, no keyed state, stage keeps duplicates
(they are resolved by the merge). Each micro-batch is written through
``foreachBatch`` as stage batch ``stream-<batch_id>`` with dynamic
partition overwrite, so a micro-batch replayed after a failure replaces
its own output instead of appending it twice.
"""

from __future__ import annotations

import contextlib
import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.deadletter import SOURCE_STREAM, file_dead_letters
from tidemark.operators.decode import OPENABLE, decode_paths, openable_scheme, scheme_of
from tidemark.operators.route import TAG_DEAD, TAG_OBJECT, extract_object_path, split_by_tag
from tidemark.plans.jobs import (
    PipelineConfig, decode_listing, ingest_decoded, persist, unknown_folder_dead_letters,
)
from tidemark.functions.paths import folder_of
from tidemark.plans.storage import delete_path, path_exists, read_text, write_text
from tidemark.session import apply_session_conf, shuffle_files_dropped
from tidemark.sources.notifications import read_notifications
from tidemark.sources.objects import new_objects, objects_seen, stream_objects

DEFAULT_TRIGGER = "30 seconds"


def _clock() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def batch_clock(spark: SparkSession, checkpoint_location: str | None, batch_id: int,
                now_fn: Callable[[], dt.datetime]) -> dt.datetime:
    """``now`` of a micro-batch, fixed at its first attempt.

    Kept next to the stream checkpoint, so a replay after a failure stamps
    the same ``ingestion_timestamp`` and lands in the same ``p_date`` /
    ``ingest_batch`` partitions, which the dynamic overwrite then replaces:
    the stage gets each micro-batch exactly once."""
    if not checkpoint_location:
        return now_fn()
    path = f"{checkpoint_location.rstrip('/')}/tidemark_clock/{batch_id}"
    saved = read_text(spark, path)
    if saved:
        return dt.datetime.fromisoformat(saved.strip())
    now = now_fn().astimezone(dt.timezone.utc)
    write_text(spark, path, now.isoformat())
    # a batch is never replayed once later ones have begun
    delete_path(spark, f"{checkpoint_location.rstrip('/')}/tidemark_clock/{batch_id - CLOCKS_KEPT}")
    return now


#: Files of the last micro-batches' clocks that stay.
CLOCKS_KEPT = 100


@contextlib.contextmanager
def decoded_once(spark: SparkSession, rows: DataFrame, root: str, batch_id: int):
    """The decoded rows of a micro-batch, written by folder before they fan out
    to its outputs: an executor lost between two outputs loses none of them, and
    no object is opened again. The copy goes when the batch is done; one that a
    failed attempt left is replaced by the next attempt of the batch."""
    path = f"{root.rstrip('/')}/tidemark_decoded/{batch_id}"
    with shuffle_files_dropped(spark):
        rows.write.mode("overwrite").partitionBy("folder").parquet(path)
    try:
        yield spark.read.schema(rows.schema).parquet(path).select(*rows.columns)
    finally:
        delete_path(spark, path)


def object_batch_writer(spark: SparkSession, cfg: PipelineConfig,
                        now_fn: Callable[[], dt.datetime] = _clock,
                        checkpoint_location: str | None = None):
    """foreachBatch body for the direct object stream."""

    def run(batch: DataFrame, batch_id: int) -> None:
        now = batch_clock(spark, checkpoint_location, batch_id, now_fn)
        known, unknown_dl = unknown_folder_dead_letters(batch, cfg, SOURCE_STREAM, now)
        with decoded_once(spark, decode_listing(known, cfg.objects_root), checkpoint_location or cfg.lake_root, batch_id) as decoded:
            ingest_decoded(spark, cfg, decoded, now, f"stream-{batch_id}", SOURCE_STREAM, [unknown_dl])

    return run


def lists_by_tasks(spark: SparkSession, cfg: PipelineConfig, checkpoint_location: str, max_files_per_trigger: int | None) -> bool:
    """Whether the object stream lists by tasks: where these can open the
    objects, unless a batch is to be cut to so many files, or the checkpoint is
    one that a file source has begun."""
    if max_files_per_trigger or scheme_of(cfg.objects_root) not in OPENABLE:
        return False
    return path_exists(spark, objects_seen(checkpoint_location)) or not path_exists(spark, f"{checkpoint_location.rstrip('/')}/offsets")


def listed_batch_writer(spark: SparkSession, cfg: PipelineConfig, now_fn: Callable[[], dt.datetime], checkpoint_location: str):
    """foreachBatch body for the object stream that lists by tasks: each tick is
    a micro-batch of the objects that are new at it (nothing is done when there
    are none)."""
    write = object_batch_writer(spark, cfg, now_fn, checkpoint_location)

    def run(_tick: DataFrame, batch_id: int) -> None:
        objects = new_objects(spark, cfg.objects_root, checkpoint_location, batch_id, cfg.lake_root)
        if not objects.isEmpty():
            write(objects, batch_id)

    return run


def notification_batch_writer(spark: SparkSession, cfg: PipelineConfig, scheme: str = "gs",
                              now_fn: Callable[[], dt.datetime] = _clock,
                              checkpoint_location: str | None = None):
    """foreachBatch body for the notification stream (S1): filter, route,
    then each task opens its objects by URI."""

    def run(batch: DataFrame, batch_id: int) -> None:
        now = batch_clock(spark, checkpoint_location, batch_id, now_fn)
        naive = now.astimezone(dt.timezone.utc).replace(tzinfo=None)
        ext = persist(extract_object_path(batch, scheme))
        try:
            parts = split_by_tag(ext, [TAG_DEAD, TAG_OBJECT])
            bad_msgs = file_dead_letters(
                parts[TAG_DEAD].select("table", "source_file", "error"),
                SOURCE_STREAM, naive, cfg.subscription)
            # a redelivered notification must not read its object twice
            objs = (parts[TAG_OBJECT]
                    .select(F.col("source_file").alias("path"), "name")
                    .dropDuplicates(["path"])
                    .withColumn("folder", folder_of("name")))
            known, unknown_dl = unknown_folder_dead_letters(objs, cfg, SOURCE_STREAM, now)
            rows = decode_paths(known.withColumn("folder", folder_of("name")))
            with decoded_once(spark, rows, checkpoint_location or cfg.lake_root, batch_id) as decoded:
                ingest_decoded(spark, cfg, decoded, now, f"stream-{batch_id}", SOURCE_STREAM, [bad_msgs, unknown_dl])
        finally:
            ext.unpersist()

    return run


def stream_ingest(spark: SparkSession, cfg: PipelineConfig, checkpoint_location: str,
                  source: str = "objects", notifications_path: str | None = None,
                  scheme: str = "gs", trigger: str | None = DEFAULT_TRIGGER,
                  available_now: bool = False, max_files_per_trigger: int | None = None,
                  now_fn: Callable[[], dt.datetime] = _clock,
                  query_name: str | None = None) -> StreamingQuery:
    """Start the ingest stream. ``source="objects"`` discovers new objects
    under ``cfg.objects_root`` (S2); ``source="notifications"`` follows
    finalize notifications under ``notifications_path`` (S1)."""
    apply_session_conf(spark)  # UTC dates for p_date
    if source == "objects":
        if lists_by_tasks(spark, cfg, checkpoint_location, max_files_per_trigger):
            if not path_exists(spark, cfg.objects_root):
                stream_objects(spark, cfg.objects_root)  # refuses a root that isn't there; of one that is, the driver would hold the listing
            stream = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", "1").option("numPartitions", "1").load()
            body = listed_batch_writer(spark, cfg, now_fn, checkpoint_location)
        else:
            stream = stream_objects(spark, cfg.objects_root, max_files_per_trigger)
            body = object_batch_writer(spark, cfg, now_fn, checkpoint_location)
    elif source == "notifications":
        if not notifications_path:
            raise ValueError("notifications_path is required for source='notifications'")
        openable_scheme(f"{scheme}://")
        stream = read_notifications(spark, notifications_path, max_files_per_trigger)
        body = notification_batch_writer(spark, cfg, scheme, now_fn, checkpoint_location)
    else:
        raise ValueError(f"unknown source {source!r}")
    w = stream.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint_location)
    if query_name:
        w = w.queryName(query_name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif trigger:
        w = w.trigger(processingTime=trigger)
    return w.start()


def append_stage_stream(rows: DataFrame, store, checkpoint_location: str,
                        trigger: str | None = DEFAULT_TRIGGER, available_now: bool = False
                        ) -> StreamingQuery:
    """K1 building block: a streaming DataFrame of shaped stage rows
    (row columns + partition column) appended every ``trigger`` as stage
    batch ``stream-<id>`` (replay-safe, see module doc)."""
    def run(batch: DataFrame, batch_id: int) -> None:
        store.append(batch, f"stream-{batch_id}")

    w = rows.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint_location)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()

"""End-to-end jobs: ingest of object batches, merges, daily reprocess
(M3, L2, L3, R-4, X3)."""

from __future__ import annotations

import datetime as dt
import logging
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.paths import folder_of, relative_name
from tidemark.operators.decode import CHANGED, OPENABLE, decode_objects, decode_paths, scheme_of
from tidemark.operators.deadletter import (
    SOURCE_BATCH, SOURCE_STREAM, fanout_dead_letters, file_dead_letters,
    read_dead_letters, row_dead_letters, union_dead_letters, write_dead_letters,
)
from tidemark.operators.dedup import latest_for_spec
from tidemark.operators.merge import (
    DEFAULT_BROADCAST_BYTES, broadcast_limit, measure_bytes, merge_insert_only,
)
from tidemark.operators.quality import key_gate, release_checked, split_rejects
from tidemark.operators.route import TAG_DEAD, UNKNOWN, UNKNOWN_FOLDER_ERROR, registry_frame
from tidemark.operators.shape import (
    REFUSED, REFUSED_RECORD, project_explicit, stage_rows, with_partition_date, with_provenance, wrap_payload,
)
from tidemark.operators.views import as_date, stage_window, with_identity
from tidemark.plans.storage import CatalogGoldStore, GoldStore, StageStore
from tidemark.session import apply_session_conf, materialize, release
from tidemark.sources.objects import list_changed, lookback_cutoff, parse_execution_date
from tidemark.specs import DEAD_LETTER_PARTITION, EXPLICIT, INGESTION_TS, LAST_UPDATED, FolderSpec, Registry, default_registry

log = logging.getLogger(__name__)


@dataclass
class PipelineConfig:
    """Where things live. Paths may be any Hadoop-supported URI."""

    lake_root: str
    objects_root: str
    registry: Registry = field(default_factory=default_registry)
    dead_letter_path: str | None = None
    subscription: str = "deadletter"
    merge_strategy: str = "auto"
    broadcast_bytes: int = DEFAULT_BROADCAST_BYTES
    # folder → catalog table with row-level MERGE (see CatalogGoldStore)
    catalog_gold: dict = field(default_factory=dict)
    # gold versions kept after a commit (readers still on an older one)
    keep_versions: int = 3
    # payload gold written by this library holds canonical JSON text, so the
    # text is the identity; set True for gold loaded from elsewhere (then
    # every merge re-canonicalises all gold payloads)
    canonicalize_gold: bool = False

    def stage(self, spec: FolderSpec) -> StageStore:
        return StageStore(f"{self.lake_root}/stage/{spec.stage_table}", spec)

    def gold(self, spec: FolderSpec) -> GoldStore:
        return GoldStore(f"{self.lake_root}/gold/{spec.gold_table}", spec)

    @property
    def dead_letters(self) -> str:
        return self.dead_letter_path or f"{self.lake_root}/deadletter"


@dataclass
class IngestResult:
    batch_id: str
    stage_rows: dict = field(default_factory=dict)
    dead_letters: DataFrame | None = None


def _utc_naive(d) -> dt.datetime:
    return parse_execution_date(d).replace(tzinfo=None)


def shape_folder(decoded: DataFrame, spec: FolderSpec, now, cache: bool = True
                 ) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Decoded good records of one folder → (stage rows, refused rows with
    their error, rows to release when both have been used)."""
    recs = decoded.filter((F.col("folder") == spec.folder) & F.col("error").isNull())
    recs = with_provenance(recs, now, "path")
    if spec.schema_type == EXPLICIT:
        raw = project_explicit(recs.select("source_file", INGESTION_TS, "record_json"), spec)
        good, bad = split_rejects(raw, spec, cache=cache)
        return (stage_rows(with_partition_date(good, INGESTION_TS, spec.partition_col), spec),
                bad.select(*spec.business_columns, REFUSED_RECORD, "source_file", INGESTION_TS, "error"), good if cache else None)
    shaped = wrap_payload(recs, "record_json", "modificationTime")
    bad = shaped.filter(F.col(REFUSED).isNotNull()).select(
        F.col("record_json").alias("payload"), "source_file", INGESTION_TS, F.col(REFUSED).alias("error"))
    return stage_rows(shaped.filter(F.col(REFUSED).isNull()), spec), bad, None


def ingest_decoded(spark: SparkSession, cfg: PipelineConfig, decoded: DataFrame, now,
                   batch_id: str, source: str, extra_dead: list[DataFrame] = ()) -> IngestResult:
    """Append every folder's rows to its stage; everything refused goes to
    the dead letter. ``decoded`` must carry ``folder`` and be materialised
    (persisted/checkpointed) by the caller: it feeds several outputs."""
    now_ts = _utc_naive(now)
    res = IngestResult(batch_id)
    dead = list(extra_dead)
    reg = F.broadcast(registry_frame(spark, cfg.registry))
    errors = (
        decoded.filter(F.col("error").isNotNull())
        .join(reg, "folder", "left")
        .select(F.coalesce("stage_table", F.lit(UNKNOWN)).alias("table"),
                F.col("path").alias("source_file"), "error")
    )
    dead.append(file_dead_letters(errors, source, now_ts, cfg.subscription))
    # an object found to change while it was read has given records already
    changed = decoded.filter(F.startswith(F.col("error"), F.lit(f"{CHANGED}:"))).select("path")
    decoded = decoded.join(changed, "path", "left_anti")
    cached = []
    try:
        for spec in cfg.registry:
            rows, bad, held = shape_folder(decoded, spec, now_ts)
            cached.append(held)
            try:
                cfg.stage(spec).append(rows, batch_id)
            except Exception as exc:
                # One dead letter per parsed file of this folder, then fail.
                files = decoded.filter((F.col("folder") == spec.folder)
                                       & F.col("error").isNull()) \
                    .select(F.col("path").alias("source_file"))
                write_dead_letters(
                    fanout_dead_letters(files, spec.stage_table, str(exc), source, now_ts,
                                        cfg.subscription), cfg.dead_letters)
                raise
            # the text of a record is in its letter only where there are no columns for it
            columns = [*spec.business_columns, REFUSED_RECORD] if spec.schema_type == EXPLICIT else ["payload"]
            dead.append(row_dead_letters(bad, spec.stage_table, columns + ["source_file", INGESTION_TS],
                                         source, now_ts, cfg.subscription))
        res.dead_letters = union_dead_letters(*dead)
        write_dead_letters(res.dead_letters, cfg.dead_letters, cfg.lake_root)
    finally:
        for c in cached:
            if c is not None:
                release_checked(c)
    return res


def decode_listing(objects: DataFrame, root: str) -> DataFrame:
    """Decode listed objects and tag each record with its folder.

    Tasks open and stream objects by their URI, whatever their size; under a
    scheme that only Spark's readers know the scanned ``content`` is decoded
    instead (an object then has to fit in a row). The decoder is the same."""
    folder = folder_of(relative_name("path", root))
    if scheme_of(root) not in OPENABLE:
        return decode_objects(objects).withColumn("folder", folder)
    return decode_paths(objects.select("path", "modificationTime", folder.alias("folder")), mtime_col="modificationTime")


def unknown_folder_dead_letters(objects: DataFrame, cfg: PipelineConfig, source: str, now
                                ) -> tuple[DataFrame, DataFrame]:
    """(objects of registered folders, dead letters for the rest)."""
    spark = objects.sparkSession
    reg = F.broadcast(registry_frame(spark, cfg.registry).select("folder"))
    tagged = objects.withColumn("folder", folder_of("name"))
    known = tagged.join(reg, "folder", "left_semi").drop("folder")
    unknown = tagged.join(reg, "folder", "left_anti").select(
        F.lit(UNKNOWN).alias("table"), F.col("path").alias("source_file"),
        F.concat(F.lit(UNKNOWN_FOLDER_ERROR), F.col("folder")).alias("error"))
    return known, file_dead_letters(unknown, source, _utc_naive(now), cfg.subscription)


# -- merges --------------------------------------------------------------------
def merge_source(stage: DataFrame, spec: FolderSpec, as_of, days: int) -> DataFrame:
    """Windowed stage, one row per key (explicit) or per canonical payload.
    Rows without a key or payload don't take part (see ``keyless_rows``)."""
    recent = stage_window(stage, as_of, days, spec.partition_col)
    named = with_identity(recent.select(*spec.row_columns), spec)
    return latest_for_spec(named.filter(F.col(spec.identity_col).isNotNull()), spec)


def keyless_rows(stage: DataFrame, spec: FolderSpec, as_of, days: int) -> DataFrame:
    """Every windowed stage row that gold's key can't take, with its error."""
    recent = stage_window(stage, as_of, days, spec.partition_col).select(*spec.row_columns)
    return key_gate(with_identity(recent, spec), spec.identity_col)[1].select(*spec.row_columns, "error")


def reported_letters(spark: SparkSession, cfg: PipelineConfig, since) -> DataFrame:
    """Names of the dead letters published on ``since`` or later (only those
    dates' partitions, and that column, are read)."""
    letters = read_dead_letters(spark, cfg.dead_letters)
    return letters.where(F.col(DEAD_LETTER_PARTITION) >= F.lit(since)).select("message_id")


def report_keyless(spark: SparkSession, cfg: PipelineConfig, spec: FolderSpec, rows: DataFrame, now_ts,
                   source_name: str, since) -> None:
    """Dead letters of rows without a key: one for each row, and none for a row
    that an earlier merge of the same window has reported. A letter's
    ``message_id`` is the digest of the row, its table and error, so it names
    the reported row; a row can't have been reported before the day that it was
    staged, so only the letters published since the window began are read."""
    letters, tmp = materialize(row_dead_letters(rows, spec.gold_table, spec.row_columns, source_name, now_ts,
                                                cfg.subscription), f"keyless-{spec.folder}", cfg.lake_root)
    try:
        if letters.limit(1).count():
            fresh = letters.join(reported_letters(spark, cfg, since), "message_id", "left_anti").select(*letters.columns)
            write_dead_letters(fresh, cfg.dead_letters, cfg.lake_root)
    finally:
        release(spark, tmp)


def merge_folder(spark: SparkSession, cfg: PipelineConfig, spec: FolderSpec, as_of,
                 days: int, now=None, source_name: str = SOURCE_BATCH) -> dict:
    """M3: promote the stage window of one folder into its gold table."""
    apply_session_conf(spark)  # DATE(ingestion_timestamp) is a UTC date
    now_ts = _utc_naive(now if now is not None else dt.datetime.now(dt.timezone.utc))
    stage = cfg.stage(spec).read(spark, as_of)
    gold_store = cfg.gold(spec)
    # the deduplicated window is small and read several times: materialise
    # it once in the shared checkpoint folder (also cuts its lineage)
    src, tmp = materialize(merge_source(stage, spec, as_of, days), f"merge-{spec.folder}", cfg.lake_root)
    try:
        # a job may be rerun with an earlier clock than its window's
        since = min(as_date(as_of), now_ts.date()) - dt.timedelta(days=int(days))
        report_keyless(spark, cfg, spec, keyless_rows(stage, spec, as_of, days), now_ts, source_name, since)
        return _merge_with(spark, cfg, spec, src, gold_store, now_ts, source_name)
    finally:
        release(spark, tmp)


def _merge_with(spark, cfg: PipelineConfig, spec: FolderSpec, src: DataFrame, gold_store: GoldStore,
                now_ts, source_name: str) -> dict:
    if spec.folder in cfg.catalog_gold:
        return _merge_catalog(spark, cfg, spec, src, now_ts, source_name)
    if spec.schema_type == EXPLICIT:
        n, size = measure_bytes(src)
        if n == 0:  # nothing to promote: keep the current version, write nothing
            return {"folder": spec.folder, "source_rows": 0, "strategy": "none",
                    "version": gold_store.current_version(spark)}
        strategy = ("shuffle" if cfg.merge_strategy == "shuffle"
                    else "broadcast" if size <= broadcast_limit(spark, cfg.broadcast_bytes) else "shuffle")
        done = gold_store.upsert(spark, src, strategy == "broadcast", cfg.lake_root)
        gold_store.vacuum(spark, keep=cfg.keep_versions)
        return {"folder": spec.folder, "source_rows": n, "source_bytes": size,
                "strategy": strategy if done["changed"] else "unchanged", **done}
    ident = "_identity"
    n = src.count()
    if n == 0:
        return {"folder": spec.folder, "source_rows": 0, "version": gold_store.current_version(spark)}

    def fresh(gold):
        # TO_JSON_STRING(T.payload): stored payloads are canonical already
        gold_i = with_identity(gold, spec) if cfg.canonicalize_gold else gold.withColumn(ident, F.col("payload"))
        return merge_insert_only(gold_i, src, ident, spec.row_columns, now_ts, LAST_UPDATED,
                                 cfg.merge_strategy, cfg.broadcast_bytes)

    version = gold_store.append(spark, fresh)
    gold_store.vacuum(spark, keep=cfg.keep_versions)
    return {"folder": spec.folder, "source_rows": n, "version": version}


def _merge_catalog(spark, cfg: PipelineConfig, spec: FolderSpec, src: DataFrame, now_ts,
                   source_name: str) -> dict:
    store = CatalogGoldStore(cfg.catalog_gold[spec.folder], spec)
    if spec.schema_type == EXPLICIT:
        store.upsert(src)
    else:
        store.insert_only(src, now_ts, LAST_UPDATED)
    return {"folder": spec.folder, "table": store.table, "strategy": "catalog_merge"}


def hourly_merge(spark: SparkSession, cfg: PipelineConfig, as_of=None, now=None,
                 expire: bool = True) -> list[dict]:
    """L3: every folder with its hourly lookback, then stage retention (the
    source's partition expiry: partitions 7 days old are dropped)."""
    as_of = as_of or dt.datetime.now(dt.timezone.utc).date()
    out = [merge_folder(spark, cfg, s, as_of, s.hourly_days, now) for s in cfg.registry]
    if expire:
        for s, m in zip(cfg.registry, out):
            m["expired"] = cfg.stage(s).expire(spark, as_of)
            m["compacted"] = cfg.stage(s).compact(spark, as_of)
    return out


# -- daily reprocess ---------------------------------------------------------
def daily_reprocess(spark: SparkSession, cfg: PipelineConfig, execution_date=None,
                    now=None, as_of=None) -> dict:
    """L2: re-read every registered folder's objects updated in the last
    ``REPROCESS_DAYS``, append them to stage, then merge each folder with
    its daily lookback. ``now`` stamps ingestion (default: wall clock)."""
    exec_dt = parse_execution_date(execution_date)  # raises before any write
    apply_session_conf(spark)
    now = now if now is not None else dt.datetime.now(dt.timezone.utc)
    as_of = as_of or dt.datetime.now(dt.timezone.utc).date()
    cutoff = lookback_cutoff(exec_dt)
    held: list[str] = []
    listings = [list_changed(spark, cfg.objects_root, s.folder, cutoff, cfg.lake_root, held) for s in cfg.registry]
    objects = listings[0]
    for extra in listings[1:]:
        objects = objects.unionByName(extra)
    # a folder's records lie together, so shaping a folder reads no other's
    decoded, tmp = materialize(decode_listing(objects, cfg.objects_root), "daily-decoded", cfg.lake_root, ("folder",))
    for path in held:
        release(spark, path)
    batch_id = f"daily-{exec_dt.strftime('%Y%m%dT%H%M%S')}"
    try:
        res = ingest_decoded(spark, cfg, decoded, now, batch_id, SOURCE_BATCH)
    finally:
        release(spark, tmp)
    merges = [merge_folder(spark, cfg, s, as_of, s.daily_days, now) for s in cfg.registry]
    return {"batch_id": batch_id, "merges": merges, "result": res}


def persist(df: DataFrame) -> DataFrame:
    return df.persist(StorageLevel.MEMORY_AND_DISK)


__all__ = [
    "PipelineConfig", "ingest_decoded", "decode_listing", "merge_folder", "merge_source",
    "hourly_merge", "daily_reprocess", "unknown_folder_dead_letters", "SOURCE_STREAM",
    "TAG_DEAD",
]

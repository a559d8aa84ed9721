"""Layer fixtures derived from the driver's tables.

Every fixture is a Spark derivation of a whole input table (no sampling,
no id subsets), so its work grows with the table. The same derivations
are written as SQL in ``__spark_entry__.oracle_sql`` for the DuckDB check.

``events`` is read as a stream of Order_Events records:

* each event is one record; key ``record_id`` = the user, ordered by the
  event time (``ingestion_timestamp`` = ``ts``), partition ``p_date`` =
  ``DATE(ts)``;
* gold (before a merge) holds the latest *high-value purchase or view* per
  user; stage holds every other event, so each event lands in a layer. Users
  without a high-value purchase/view exercise the insert branch, and
  purchase/views newer than a user's stage events the "matched, not newer" one.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.jsonfn import canonical_json
from tidemark.operators.dedup import latest_for_spec
from tidemark.operators.views import with_identity
from tidemark.specs import LAST_UPDATED, NOTIFICATION_EVENTS, ORDER_EVENTS

AS_OF = dt.date(2024, 1, 30)
GOLD_TYPES = ("purchase", "view")
GOLD_MIN_VALUE = 150.0
NOW = dt.datetime(2024, 1, 31, 12, 0, 0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ts(col: str = "ts") -> Column:
    """Driver tables store TIMESTAMP_NTZ; the lake uses TIMESTAMP (UTC)."""
    return F.col(col).cast("timestamp")


def record_text_columns() -> list[Column]:
    """Order_Events fields of an event, as the text an upstream producer
    writes into the JSON object."""
    return [
        F.col("user_id").cast("string").alias("record_id"),
        F.date_format("ts", "yyyy-MM-dd").alias("order_date"),
        F.date_format(F.date_add(F.to_date("ts"), 2), "yyyy-MM-dd").alias("ship_date"),
        F.col("event_id").cast("string").alias("order_ref"),
        F.col("props").alias("source_code"),
        F.col("event_type").alias("category"),
        F.when(F.col("value") >= 100, "high").otherwise("low").alias("status"),
        F.when(F.col("event_type").isin("click", "view"), "web").otherwise("app").alias("channel"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("event_timestamp"),
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("customer_name"),
        F.when(F.col("event_type") != "error", F.upper(F.substring("event_type", 1, 2)))
        .alias("region_code"),
        F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit("@example.com"))
        .alias("contact_email"),
    ]


def event_source_file() -> Column:
    return F.concat(F.lit("events/"), F.col("event_type"), F.lit("/"),
                    F.col("event_id").cast("string"), F.lit(".json.gz"))


def event_rows(events: DataFrame) -> DataFrame:
    """Typed Order_Events stage rows (+ ``p_date``) for every event, plus
    ``event_type`` / ``value`` for the layer split."""
    return events.select(
        F.col("user_id").cast("string").alias("record_id"),
        F.to_date("ts").alias("order_date"),
        F.date_add(F.to_date("ts"), 2).alias("ship_date"),
        F.col("event_id").cast("string").alias("order_ref"),
        F.col("props").alias("source_code"),
        F.col("event_type").alias("category"),
        F.when(F.col("value") >= 100, "high").otherwise("low").alias("status"),
        F.when(F.col("event_type").isin("click", "view"), "web").otherwise("app").alias("channel"),
        _ts().alias("event_timestamp"),
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("customer_name"),
        F.when(F.col("event_type") != "error", F.upper(F.substring("event_type", 1, 2)))
        .alias("region_code"),
        F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit("@example.com"))
        .alias("contact_email"),
        event_source_file().alias("source_file"),
        _ts().alias("ingestion_timestamp"),
        F.to_date("ts").alias("p_date"),
        "event_type", "value",
    )


def _is_gold_source() -> Column:
    return F.coalesce(F.col("event_type").isin(*GOLD_TYPES) & (F.col("value") >= GOLD_MIN_VALUE), F.lit(False))


def explicit_layers(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(gold before merge, stage) for Order_Events."""
    rows = event_rows(events)
    spec = ORDER_EVENTS
    gold = latest_for_spec(rows.filter(_is_gold_source()).select(*spec.row_columns), spec)
    stage = rows.filter(~_is_gold_source()).select(
        *spec.row_columns, spec.partition_col)
    return gold, stage


def payload_rows(events: DataFrame) -> DataFrame:
    return events.select(
        canonical_json("props").alias("payload"),
        event_source_file().alias("source_file"),
        _ts().alias("ingestion_timestamp"),
        F.to_date("ts").alias("_partition_date"),
        "event_type", "value",
    )


def payload_layers(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(gold before merge, stage) for a payload folder: the payload is the
    event's ``props`` document (identity = canonical JSON text)."""
    spec = NOTIFICATION_EVENTS
    rows = payload_rows(events)
    g = with_identity(rows.filter(_is_gold_source()).select(*spec.row_columns), spec)
    gold = latest_for_spec(g, spec).select(
        *spec.row_columns, F.col("ingestion_timestamp").alias(LAST_UPDATED))
    stage = rows.filter(~_is_gold_source()).select(
        *spec.row_columns, spec.partition_col)
    return gold, stage


def as_ntz(df: DataFrame) -> DataFrame:
    """Timestamps as TIMESTAMP_NTZ (UTC wall clock) for the SQL oracle."""
    out = []
    for f in df.schema.fields:
        if f.dataType.typeName() == "timestamp":
            out.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


# ---------------------------------------------------------------------------
# Object fixtures: events written as gzip JSON objects
# ---------------------------------------------------------------------------
GOOD_NDJSON = "ndjson"
GOOD_ARRAY = "array"
BAD_LINE = "bad_line"          # NDJSON + a line that is not JSON
NOT_GZIP = "not_gzip"          # plain bytes, no gzip framing
TRAILING_TEXT = "trailing"     # array followed by text
BLANK = "blank"                # no byte inside the gzip framing
SPACES = "spaces"              # white space only
NOT_OBJECTS = "not_objects"    # array of records, then one that is no object
SCALAR_LINE = "scalar_line"    # NDJSON with a last line that is no object
ODD_FILE_LAYOUT = {
    "click": BLANK,
    "view": SPACES,
    "error": NOT_OBJECTS,
    "signup": SCALAR_LINE,
    "purchase": GOOD_ARRAY,
}
BAD_FILE_LAYOUT = {
    "click": GOOD_NDJSON,
    "view": GOOD_ARRAY,
    "error": BAD_LINE,
    "signup": NOT_GZIP,
    "purchase": TRAILING_TEXT,
}


ARRAYS = (GOOD_ARRAY, TRAILING_TEXT, NOT_OBJECTS)


def object_name_col(folder: str | Column = "Order_Events") -> Column:
    f = F.lit(folder) if isinstance(folder, str) else folder
    return F.concat(f, F.lit("/"), F.col("event_type"), F.lit("/u"),
                    F.col("user_id").cast("string"), F.lit(".json.gz"))


#: Characters of records that a writing task holds before it compresses them.
_HELD_CHARS = 1 << 16


def _object_writer(root: str, layouts: dict[str, str], default: str):
    def write(batches):
        import zlib

        import pandas as pd
        from pyarrow import fs as pafs

        filesystem, base = pafs.FileSystem.from_uri(root) if "://" in root \
            else (pafs.LocalFileSystem(), root)
        tails = {GOOD_ARRAY: b"]", TRAILING_TEXT: b"] trash", BAD_LINE: b"\n{oops\n", SPACES: b" \n\t\r\n ",
                 NOT_OBJECTS: b",7]", SCALAR_LINE: b'\n"text"\n'}
        folders = set()
        name = layout = sink = gz = None
        held, size, n = [], 0, 0
        written = []

        def put(data):
            sink.write(gz.compress(data) if gz else data)

        def flush():
            nonlocal size
            put("".join(held).encode("utf-8"))
            held.clear()
            size = 0

        def close():
            if sink is None:
                return
            flush()
            put(tails.get(layout, b""))
            if gz:
                sink.write(gz.flush())
            sink.close()
            written.append((name, n))

        for pdf in batches:
            for next_name, et, rec in zip(pdf["name"], pdf["event_type"], pdf["record_json"]):
                if next_name is None:
                    raise ValueError("a record without an object name can't be written")
                if next_name != name:
                    close()
                    name, layout, n = next_name, layouts.get(et, default), 0
                    path = f"{base}/{name}"
                    folder = path.rsplit("/", 1)[0]
                    if folder not in folders:
                        filesystem.create_dir(folder, recursive=True)
                        folders.add(folder)
                    sink = filesystem.open_output_stream(path, compression=None)
                    gz = None if layout == NOT_GZIP else zlib.compressobj(1, wbits=31)
                    if layout in ARRAYS:
                        put(b"[")
                if layout in (BLANK, SPACES):
                    continue
                if n:
                    held.append("," if layout in ARRAYS else "\n")
                held.append(rec)
                size += len(rec)
                n += 1
                if size > _HELD_CHARS:
                    flush()
        close()
        yield pd.DataFrame(written, columns=["name", "n_records"])

    return write


def write_event_objects(events: DataFrame, root: str, layouts: dict[str, str] | None = None,
                        default: str = GOOD_NDJSON, folder: str | Column = "Order_Events"
                        ) -> DataFrame:
    """Write every event as one record of a gzip JSON object
    ``<folder>/<event_type>/u<user_id>.json.gz`` under ``root``.

    Objects are written by the tasks (through ``pyarrow.fs``), streaming the
    records of one object after another; no object is collected in memory.
    Returns the written objects ``(name, n_records)`` (already executed)."""
    recs = events.select(
        object_name_col(folder).alias("name"), "event_type", "event_id",
        F.to_json(F.struct(*record_text_columns())).alias("record_json"),
    )
    return write_objects(recs, root, layouts, default)


def write_objects(recs: DataFrame, root: str, layouts: dict[str, str] | None = None, default: str = GOOD_NDJSON) -> DataFrame:
    """``write_event_objects`` for any records (name, event_type, event_id,
    record_json)."""
    # explicit count: AQE must not coalesce the writers into one task
    n = 2 * recs.sparkSession.sparkContext.defaultParallelism
    written = (
        recs.repartition(n, "name")
        .sortWithinPartitions("name", "event_id")
        .mapInPandas(_object_writer(root, layouts or {}, default), "name string, n_records long")
    )
    manifest = f"{root.rstrip('/')}/_manifest"
    written.write.mode("overwrite").parquet(manifest)  # runs the writers once
    return recs.sparkSession.read.parquet(manifest)


_OBJECT_SETS: dict = {}


def event_objects(events: DataFrame, sf_dir: str, layouts: dict[str, str] | None = None,
                  default: str = GOOD_NDJSON, folder: str = "Order_Events") -> tuple[str, DataFrame]:
    """Write-once, read-only object fixture shared by the queries of one
    process: ``(root, manifest)``. Written again if its folder is gone."""
    from tidemark.plans.storage import path_exists
    from tidemark.session import checkpoint_root, work_dir

    spark = events.sparkSession
    key = (checkpoint_root(spark), sf_dir.rstrip("/"), tuple(sorted((layouts or {}).items())),
           default, folder)
    root = _OBJECT_SETS.get(key)
    if root is None or not path_exists(spark, f"{root}/_manifest"):
        root = work_dir(spark, "objects")
        write_event_objects(events, root, layouts, default, folder)
        _OBJECT_SETS[key] = root
    return root, spark.read.parquet(f"{root}/_manifest")

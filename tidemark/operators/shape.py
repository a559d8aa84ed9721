"""Record shaping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.jsonfn import canonical_json
from tidemark.functions.timestamps import safe_timestamp
from tidemark.specs import (
    INGESTION_TS, PAYLOAD_PARTITION, SOURCE_FILE, STAGE_PARTITION, FolderSpec,
)


def with_provenance(df: DataFrame, now, source_col: str = "path") -> DataFrame:
    """``source_file`` = object URI, ``ingestion_timestamp`` = ``now``.

    ``now`` is an argument (one value per file batch / micro-batch) so a
    replay stamps the same time; ``None`` falls back to the query clock."""
    ts = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    return df.withColumn(SOURCE_FILE, F.col(source_col)).withColumn(INGESTION_TS, ts)


def with_partition_date(df: DataFrame, col: str = INGESTION_TS,
                        name: str = STAGE_PARTITION) -> DataFrame:
    """``DATE(col)`` as the partition column."""
    return df.withColumn(name, F.to_date(F.col(col)))


def record_struct_schema(spec: FolderSpec) -> str:
    """DDL for one ``from_json`` pass: text for STRING/DATE columns,
    VARIANT for TIMESTAMP columns (their JSON type decides: only a JSON
    string is parsed, a number is NULL), and the text of a record that the
    parser refuses."""
    return "struct<" + ",".join(
        f"`{c}`:{'variant' if t == 'TIMESTAMP' else 'string'}" for c, t in spec.columns) + f",`{REFUSED}`:string>"


#: Reason why a record can't be shaped, and its whole text (NULL for all others).
REFUSED = "_refused"
REFUSED_RECORD = "record_json"


def project_explicit(records: DataFrame, spec: FolderSpec,
                     record_col: str = "record_json") -> DataFrame:
    """One JSON record → the folder's business columns.

    One ``from_json`` pass. STRING and DATE columns stay text (DATE is
    typed by ``split_rejects``); R1: JSON null, absent and '' → NULL, other
    scalars keep their JSON text (``5``, ``true``, ``{"k":1}``). TIMESTAMP
    columns go through ``safe_timestamp`` only when the JSON value is a
    string. Extra keys are dropped. Other columns of ``records`` are
    carried. A record that Spark's parser refuses (nested or with numbers
    beyond its limits) has ``REFUSED`` set and its whole text in
    ``REFUSED_RECORD``; ``split_rejects`` turns it away."""
    if REFUSED_RECORD in spec.business_columns:
        raise ValueError(f"{REFUSED_RECORD} holds the text of refused records; it can't name a column of {spec.folder}")
    carry = [c for c in records.columns if c not in (record_col, REFUSED_RECORD) and c not in spec.business_columns]
    # parse once per row into its own projection: Catalyst keeps an expensive
    # expression that is used many times (every field, the timestamp guard)
    # in a separate Project instead of inlining it into each use
    parsed = records.select(*carry, F.col(record_col).alias("_text"), F.from_json(
        F.col(record_col), record_struct_schema(spec), {"columnNameOfCorruptRecord": REFUSED}).alias("_rec"))
    is_refused = F.col("_rec").isNull() | F.col(f"_rec.{REFUSED}").isNotNull()
    cols = [F.when(is_refused, F.lit("unreadable record")).alias(REFUSED),
            F.when(is_refused, F.col("_text")).alias(REFUSED_RECORD)]
    for c, t in spec.columns:
        f = F.col("_rec").getField(c)
        if t == "TIMESTAMP":
            is_str = F.schema_of_variant(f) == F.lit("STRING")
            cols.append(F.when(is_str, safe_timestamp(f.try_cast("string"))).alias(c))
        else:
            cols.append(F.nullif(f, F.lit("")).alias(c))
    return parsed.select(*carry, *cols)


def wrap_payload(records: DataFrame, record_col: str = "record_json",
                 date_col: str | None = "modificationTime") -> DataFrame:
    """Whole record as canonical JSON ``payload``; payload stage is
    partitioned by the object's update date (``date_col``), falling back to
    the ingestion date where the update time is unknown (objects opened by
    URI from a notification), so the partition is never NULL. A record without
    canonical text has ``REFUSED`` set: the table's payload is NOT NULL."""
    out = records.withColumn("payload", canonical_json(record_col)) \
        .withColumn(REFUSED, F.when(F.col("payload").isNull(), F.lit("record has no lossless canonical JSON text")))
    ingest = F.col(INGESTION_TS) if INGESTION_TS in records.columns else F.lit(None)
    if date_col and date_col in records.columns:
        day = F.coalesce(F.to_date(F.col(date_col)), F.to_date(ingest))
    else:
        day = F.to_date(ingest)
    return out.withColumn(PAYLOAD_PARTITION, day)


def stage_rows(shaped: DataFrame, spec: FolderSpec) -> DataFrame:
    """Select the stage table's columns (adds ``p_date`` when missing)."""
    if spec.partition_col not in shaped.columns:
        shaped = with_partition_date(shaped, INGESTION_TS, spec.partition_col)
    return shaped.select(*spec.row_columns, spec.partition_col)

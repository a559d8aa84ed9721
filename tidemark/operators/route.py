"""Notification filtering and folder routing (F1, F2, R-1, R-2, R-3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.paths import folder_of, has_suffix, object_uri
from tidemark.specs import OBJECT_SUFFIX, Registry

# ---------------------------------------------------------------------------
# Fixed values of the notification contract and of the dead-letter texts
# (must equal the surveyed pipeline's outputs).
FINALIZE_EVENT = "OBJECT_FINALIZE"
UNKNOWN = "unknown"
TAG_OBJECT = "gcs_path"
TAG_DEAD = "dead_letter"
MISSING_BUCKET_ERROR = "PubSub parse failure: Missing bucketId; attrs="
UNKNOWN_FOLDER_ERROR = "Unrecognised folder: "
# ---------------------------------------------------------------------------


def extract_object_path(notifs: DataFrame, scheme: str = "gs") -> DataFrame:
    """keep finalize events for ``*.json.gz`` objects (others are
    dropped silently, tested in that order); a survivor without a bucket is
    a dead letter with table and source_file ``unknown``.

    Output: ``tag, bucket, name, source_file, table, error`` (+ input
    columns other than ``attributes``)."""
    attrs = F.col("attributes")
    event = F.try_element_at(attrs, F.lit("eventType"))
    name = F.coalesce(F.try_element_at(attrs, F.lit("objectId")), F.lit(""))
    bucket = F.try_element_at(attrs, F.lit("bucketId"))
    kept = notifs.filter((event == F.lit(FINALIZE_EVENT)) & has_suffix(name, OBJECT_SUFFIX))
    missing = F.coalesce(bucket, F.lit("")) == ""
    carry = [c for c in notifs.columns if c != "attributes"]
    return kept.select(
        *carry,
        F.when(missing, F.lit(TAG_DEAD)).otherwise(F.lit(TAG_OBJECT)).alias("tag"),
        bucket.alias("bucket"),
        name.alias("name"),
        F.when(missing, F.lit(UNKNOWN)).otherwise(object_uri(bucket, name, scheme)).alias("source_file"),
        F.lit(UNKNOWN).alias("table"),
        F.when(
            missing,
            F.concat(F.lit(MISSING_BUCKET_ERROR), F.to_json(attrs)),
        ).alias("error"),
    )


def registry_frame(spark: SparkSession, registry: Registry) -> DataFrame:
    rows = [(s.folder, s.stage_table, s.schema_type) for s in registry]
    return spark.createDataFrame(rows, "folder string, stage_table string, schema_type string")


def route_by_folder(objects: DataFrame, registry: Registry, name_col: str = "name") -> DataFrame:
    """R-1/R-2: folder = first segment of the object name, looked up in the
    registry (a handful of rows, broadcast: its size is the number of
    configured folders, not the data). Unknown folders become dead letters
    with table ``unknown``.

    Adds ``folder, stage_table, schema_type, tag, table, error``; ``tag`` is
    the folder name for routed objects."""
    spark = objects.sparkSession
    reg = F.broadcast(registry_frame(spark, registry))
    base = objects.drop("tag", "table", "error").withColumn("folder", folder_of(name_col))
    j = base.join(reg, "folder", "left")
    unknown = F.col("stage_table").isNull()
    return (
        j.withColumn("tag", F.when(unknown, F.lit(TAG_DEAD)).otherwise(F.col("folder")))
        .withColumn("table", F.coalesce(F.col("stage_table"), F.lit(UNKNOWN)))
        .withColumn(
            "error",
            F.when(unknown, F.concat(F.lit(UNKNOWN_FOLDER_ERROR), F.col("folder"))),
        )
    )


def split_by_tag(df: DataFrame, tags, tag_col: str = "tag") -> dict[str, DataFrame]:
    """R-3: one filtered DataFrame per tag. Persist ``df`` first when more
    than one output is written."""
    return {t: df.filter(F.col(tag_col) == F.lit(t)) for t in tags}

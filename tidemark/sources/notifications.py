"""Object notifications."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

NOTIFICATION_SCHEMA = T.StructType(
    [
        T.StructField("message_id", T.StringType(), True),
        T.StructField("publish_time", T.TimestampType(), True),
        T.StructField("attributes", T.MapType(T.StringType(), T.StringType()), True),
        T.StructField("data", T.StringType(), True),
    ]
)


def read_notifications(spark: SparkSession, path: str,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """Unbounded notifications as JSON lines under ``path``.

    Any other streaming DataFrame with the same columns (a message-bus
    connector) can be passed to the ingest instead."""
    r = spark.readStream.schema(NOTIFICATION_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.json(path)


def read_notifications_batch(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(NOTIFICATION_SCHEMA).json(path)

"""Dead letters."""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize, release
from tidemark.specs import DEAD_LETTER_PARTITION, DEAD_LETTER_SCHEMA

log = logging.getLogger(__name__)

# ---------------------------------------------------------------------------
# The ``source`` attribute each pipeline writes on its dead
# letters (must equal the surveyed pipeline's values).
SOURCE_STREAM = "Dataflow Streaming"
SOURCE_BATCH = "Airflow Daily Reprocessing"
# ---------------------------------------------------------------------------
DEFAULT_SUBSCRIPTION = "deadletter"


def _lit_or_col(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def dead_letter_rows(df: DataFrame, data: Column, table, source: str, now,
                     subscription: str = DEFAULT_SUBSCRIPTION) -> DataFrame:
    """Shape any failure rows as the dead-letter table.

    ``attributes`` = ``{"source", "table"}`` as JSON, ``data`` = JSON text,
    ``message_id`` = SHA-256 of both so a retried publish dedupes."""
    attrs = F.to_json(
        F.create_map(F.lit("source"), F.lit(source), F.lit("table"), _lit_or_col(table))
    )
    out = df.select(
        F.lit(subscription).alias("subscription_name"),
        F.lit(None).cast("string").alias("message_id"),
        F.lit(now).cast("timestamp").alias("publish_time"),
        attrs.alias("attributes"),
        data.alias("data"),
    )
    return out.withColumn(
        "message_id", F.sha2(F.concat_ws("\u0001", "attributes", "data"), 256)
    ).select(*DEAD_LETTER_SCHEMA.fieldNames())


def file_dead_letters(errors: DataFrame, source: str, now,
                      subscription: str = DEFAULT_SUBSCRIPTION) -> DataFrame:
    """``(table, source_file, error)`` → data ``{source_file, error}``."""
    data = F.to_json(F.struct(F.col("source_file"), F.col("error")))
    return dead_letter_rows(errors, data, F.col("table"), source, now, subscription)


def row_dead_letters(rejects: DataFrame, table: str, row_cols: list[str], source: str,
                     now, subscription: str = DEFAULT_SUBSCRIPTION) -> DataFrame:
    """Refused rows → data ``{row: {…}, error}``."""
    data = F.to_json(
        F.struct(F.struct(*[F.col(c) for c in row_cols]).alias("row"), F.col("error"))
    )
    return dead_letter_rows(rejects, data, table, source, now, subscription)


def fanout_dead_letters(files: DataFrame, table: str, error: str, source: str, now,
                        subscription: str = DEFAULT_SUBSCRIPTION) -> DataFrame:
    """A failed batch write → one dead letter per parsed source file."""
    f = files.select("source_file").distinct().withColumn("error", F.lit(error))
    return file_dead_letters(f.withColumn("table", F.lit(table)), source, now, subscription)


def union_dead_letters(*dfs: DataFrame) -> DataFrame:
    """Flatten dead-letter branches."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def write_dead_letters(df: DataFrame, path: str, work_root: str | None = None) -> bool:
    """Append to the dead-letter table (partitioned by publish date).

    The letters are computed first, and an error in that is raised: a job must
    not report success with its dead letters lost. Only a failure to publish
    them is logged and not raised, so it cannot mask the original one.
    Nothing is published when there are none.

    Dead letters are the union of several sparse branches (hundreds of
    mostly empty partitions); ``REBALANCE`` lets AQE pack them into files
    of a sensible size instead of one small file per input partition."""
    spark = df.sparkSession
    letters, tmp = materialize(df.hint("rebalance"), "dead-letters", work_root)
    try:
        if not letters.limit(1).count():
            return True
        (letters.withColumn(DEAD_LETTER_PARTITION, F.to_date("publish_time"))
            .write.mode("append").partitionBy(DEAD_LETTER_PARTITION).parquet(path))
        return True
    except Exception as exc:  # noqa: BLE001 - by contract
        log.error("dead-letter write to %s failed: %s", path, exc)
        return False
    finally:
        release(spark, tmp)


def read_dead_letters(spark, path: str, dedupe: bool = False) -> DataFrame:
    """The dead-letter table; ``dedupe`` drops retried publishes (same
    ``message_id``)."""
    from pyspark.sql import types as T
    schema = T.StructType(DEAD_LETTER_SCHEMA.fields + [
        T.StructField(DEAD_LETTER_PARTITION, T.DateType(), True)])
    try:
        df = spark.read.schema(schema).parquet(path)
    except Exception:
        df = spark.createDataFrame([], schema)
    return df.dropDuplicates(["message_id"]) if dedupe else df

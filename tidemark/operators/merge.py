"""MERGE without a row-level table format (M1, M2, M3 building blocks).

``merge_upsert`` returns the complete next gold snapshot as a lazy
DataFrame; ``plans.storage.GoldStore`` commits it atomically. Two physical
strategies give the same rows:

* ``shuffle``   full outer sort-merge join on the key. Gold and source are
  both exchanged on the key. Always valid.
* ``broadcast`` the (deduplicated, size-checked) source is broadcast; gold is
  streamed once through a map-side left-outer hash join and once more on
  its key column only (semi join) to find the matched keys. Gold is never
  shuffled. Chosen by ``auto`` when the source fits ``broadcast_bytes``.

Both sides are unique per key (gold by construction, source by W1), so
neither strategy can explode a hot key.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

INSERT = "insert"
UPDATE = "update"
KEEP_MATCHED = "matched_not_newer"
GOLD_ONLY = "gold_only"
ACTION = "_action"

DEFAULT_BROADCAST_BYTES = 256 << 20
#: A broadcast source stands on the driver several times over (as collected, in
#: up to three hashed relations, as the blocks that are sent), so its measured
#: bytes may be this part of the driver's heap.
_HEAP_PART = 16

_TYPE_BYTES = {
    T.StringType: 48, T.DateType: 4, T.TimestampType: 8, T.TimestampNTZType: 8,
    T.LongType: 8, T.IntegerType: 4, T.DoubleType: 8, T.BooleanType: 1,
}


def estimate_row_bytes(schema: T.StructType) -> int:
    return 16 + sum(_TYPE_BYTES.get(type(f.dataType), 64) for f in schema.fields)


def measure_bytes(source: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of ``source`` in one aggregation: fixed-width columns
    by type, string columns by their actual UTF-8 length."""
    strings = [f.name for f in source.schema.fields if isinstance(f.dataType, T.StringType)]
    fixed = 16 + sum(_TYPE_BYTES.get(type(f.dataType), 64)
                     for f in source.schema.fields if f.name not in strings)
    text = sum((F.coalesce(F.octet_length(F.col(c)), F.lit(0)) for c in strings), F.lit(0))
    row = source.agg(F.count(F.lit(1)).alias("n"), F.sum(text).alias("b")).first()
    n = int(row["n"] or 0)
    return n, n * fixed + int(row["b"] or 0)


def broadcast_limit(spark: SparkSession, broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> int:
    """``broadcast_bytes``, or what the driver has room for if that is less."""
    return min(broadcast_bytes, spark._jvm.java.lang.Runtime.getRuntime().maxMemory() // _HEAP_PART)


def choose_strategy(source: DataFrame, strategy: str = "auto",
                    broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
                    source_rows: int | None = None) -> str:
    """Every broadcast is size-checked: ``auto`` and ``broadcast`` both give
    ``broadcast`` only when rows × row width of the source is under the
    limit (and fits the driver), ``shuffle`` otherwise. Rows and string bytes are measured (one
    aggregation over the source, which callers materialise first), never
    guessed from file sizes."""
    if strategy == "shuffle":
        return strategy
    if strategy not in ("auto", "broadcast"):
        raise ValueError(f"unknown merge strategy {strategy!r}")
    if source_rows is None:
        n, size = measure_bytes(source)
    else:
        n, size = source_rows, source_rows * estimate_row_bytes(source.schema)
    chosen = "broadcast" if size <= broadcast_limit(source.sparkSession, broadcast_bytes) else "shuffle"
    log.info("merge source %d rows ≈ %d bytes → %s", n, size, chosen)
    return chosen


def checked_merge_plan(gold: DataFrame, source: DataFrame, key: str, order_col: str,
                       columns: list[str], strategy: str = "auto",
                       broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``merge_plan`` with the strategy passed through the size check."""
    chosen = choose_strategy(source, strategy, broadcast_bytes)
    return merge_plan(gold, source, key, order_col, columns, chosen)


def merge_plan(gold: DataFrame, source: DataFrame, key: str, order_col: str,
               columns: list[str], strategy: str = "shuffle") -> DataFrame:
    """Next gold rows plus ``_action`` (insert / update / matched_not_newer /
    gold_only). Low-level: ``strategy`` is taken as given; use
    ``checked_merge_plan`` / ``merge_upsert`` for a size-checked choice.

    Rules (conditional upsert): matched and ``S.order > T.order`` → the
    source row replaces every column; matched otherwise (older, equal or a
    NULL on either side) → gold kept; source only → inserted; gold only →
    kept. ``source`` must hold at most one row per key and no NULL key.
    """
    t = gold.select(*columns).alias("T")
    s = source.select(*columns).alias("S")
    tk, sk = F.col(f"T.{key}"), F.col(f"S.{key}")
    newer = F.col(f"S.{order_col}") > F.col(f"T.{order_col}")

    def pick(action_col):
        take_s = action_col.isin(INSERT, UPDATE)
        return [
            F.when(take_s, F.col(f"S.{c}")).otherwise(F.col(f"T.{c}")).alias(c)
            for c in columns
        ] + [action_col.alias(ACTION)]

    if strategy == "shuffle":
        joined = t.join(s, tk == sk, "full_outer")
        action = (
            F.when(tk.isNull(), F.lit(INSERT))
            .when(sk.isNull(), F.lit(GOLD_ONLY))
            .when(newer, F.lit(UPDATE))
            .otherwise(F.lit(KEEP_MATCHED))
        )
        return joined.select(*pick(action))

    if strategy != "broadcast":
        raise ValueError(f"unknown merge strategy {strategy!r}")
    bs = F.broadcast(s)
    updated = t.join(bs, tk == sk, "left_outer")
    action = (
        F.when(sk.isNull(), F.lit(GOLD_ONLY))
        .when(newer, F.lit(UPDATE))
        .otherwise(F.lit(KEEP_MATCHED))
    )
    gold_side = updated.select(*pick(action))
    # same projection of the source in all three uses: one broadcast, reused
    s_all = source.select(*columns)
    matched_keys = gold.select(key).join(F.broadcast(s_all), key, "left_semi")
    inserts = (
        s_all.join(F.broadcast(matched_keys), key, "left_anti")
        .withColumn(ACTION, F.lit(INSERT))
    )
    return gold_side.unionByName(inserts)


def merge_upsert(gold: DataFrame, source: DataFrame, key: str, order_col: str,
                 columns: list[str], strategy: str = "auto",
                 broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """M1: the next gold snapshot (``columns`` only)."""
    chosen = choose_strategy(source, strategy, broadcast_bytes)
    return merge_plan(gold, source, key, order_col, columns, chosen).drop(ACTION)


def merge_actions(plan: DataFrame) -> DataFrame:
    """Rows per merge branch of a ``merge_plan`` result."""
    return plan.groupBy(F.col(ACTION).alias("action")).agg(F.count(F.lit(1)).alias("n"))


def merge_insert_only(gold: DataFrame, source: DataFrame, identity: str,
                      columns: list[str], now, last_updated: str = "_last_updated",
                      strategy: str = "auto",
                      broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """M2: source rows whose identity is absent from gold, stamped with
    ``now`` in ``last_updated``. Gold rows are never changed, so the caller
    *appends* this result to gold instead of rewriting it.

    ``source`` must be deduplicated on ``identity``."""
    chosen = choose_strategy(source, strategy, broadcast_bytes)
    if chosen == "broadcast":
        present = gold.select(identity).join(
            F.broadcast(source.select(identity)), identity, "left_semi"
        )
        fresh = source.join(F.broadcast(present), identity, "left_anti")
    else:
        fresh = source.join(gold.select(identity), identity, "left_anti")
    return fresh.select(*columns).withColumn(last_updated, F.lit(now).cast("timestamp"))

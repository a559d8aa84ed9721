"""Stage window, layer union and unified views."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.jsonfn import canonical_json
from tidemark.operators.dedup import latest_for_spec, tie_breakers
from tidemark.operators.merge import DEFAULT_BROADCAST_BYTES, choose_strategy
from tidemark.specs import EXPLICIT, FolderSpec


def as_date(d: dt.date | dt.datetime | str) -> dt.date:
    if isinstance(d, dt.datetime):
        return d.date()
    if isinstance(d, dt.date):
        return d
    return dt.date.fromisoformat(str(d)[:10])


def stage_window(stage: DataFrame, as_of, days: int, partition_col: str) -> DataFrame:
    """Rows whose partition date is within ``days`` calendar days of
    ``as_of``, inclusive (``days`` = N means N+1 dates), no upper bound.

    The bound is a literal date, so the predicate lands in the scan's
    ``PartitionFilters`` on a partitioned stage (or a pushed range filter
    on a derived date)."""
    lo = as_date(as_of) - dt.timedelta(days=int(days))
    return stage.filter(F.col(partition_col) >= F.lit(lo))


def union_layers(gold: DataFrame, stage: DataFrame, columns: list[str]) -> DataFrame:
    """gold UNION ALL stage on the row columns (by name)."""
    return gold.select(*columns).unionByName(stage.select(*columns))


def with_identity(df: DataFrame, spec: FolderSpec) -> DataFrame:
    if spec.schema_type == EXPLICIT:
        return df
    return df.withColumn("_identity", canonical_json("payload"))


def unified_view(spec: FolderSpec, gold: DataFrame, stage: DataFrame, as_of,
                 days: int | None = None, strategy: str = "auto",
                 broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Freshest row per key over gold ∪ recent stage.

    Explicit: the 12 business columns (V1). Payload: payload, source_file,
    ingestion_timestamp (V2), identity = canonical payload text.

    ``strategy``:

    * ``window``    row_number over the union (exact SQL definition; gold is
      exchanged on the key at every read).
    * ``auto``      the deduplicated stage window is joined to gold. Nothing
      is measured or fixed when the view is built: adaptive execution sees the
      window's size at every read and joins map-side while it is small, so a
      registered view stays right, and safe, while its stage grows. Requires
      gold to be unique per key (which the merge maintains).
    * ``broadcast`` the same with the window broadcast and gold never
      exchanged, for one read: the window's size is measured first (one
      action), and beyond ``broadcast_bytes`` the ``window`` plan is given.
    """
    days = spec.view_days if days is None else days
    recent = stage_window(stage, as_of, days, spec.partition_col)
    out = spec.business_columns if spec.schema_type == EXPLICIT else spec.row_columns
    if strategy in ("auto", "broadcast"):
        src = latest_for_spec(with_identity(recent.select(*spec.row_columns), spec), spec)
        g = with_identity(gold.select(*spec.row_columns), spec)
        if strategy == "auto":
            return _latest_joined(g, src, spec, lambda d: d).select(*out)
        if choose_strategy(src, "auto", broadcast_bytes) == "broadcast":
            return _latest_joined(g, src, spec, F.broadcast).select(*out)
    elif strategy != "window":
        raise ValueError(f"unknown view strategy {strategy!r}")
    combined = with_identity(union_layers(gold, recent, spec.row_columns), spec)
    latest = latest_for_spec(combined, spec)
    return latest.select(*out)


def _latest_joined(gold: DataFrame, src: DataFrame, spec: FolderSpec, hint) -> DataFrame:
    """Per key, the first of (gold row, deduplicated stage row) under
    ``order_col DESC NULLS LAST, tie-breakers DESC NULLS LAST``.

    Spark orders structs field by field with NULL lowest, so
    ``struct(S order) > struct(T order)`` is exactly "S sorts first"."""
    ident = spec.identity_col
    cols = spec.row_columns + ([] if ident in spec.row_columns else [ident])
    order = [spec.order_col] + tie_breakers(spec)
    t, s = gold.select(*cols).alias("T"), src.select(*cols).alias("S")
    s_first = F.col(f"S.{ident}").isNotNull() & (
        F.struct(*[F.col(f"S.{c}") for c in order]) > F.struct(*[F.col(f"T.{c}") for c in order]))
    gold_side = t.join(hint(s), F.col(f"T.{ident}") == F.col(f"S.{ident}"), "left_outer") \
        .select(*[F.when(s_first, F.col(f"S.{c}")).otherwise(F.col(f"T.{c}")).alias(c) for c in cols])
    # the three uses of the source share one projection, so Spark reuses its
    # broadcast and its dedup exchange instead of computing them three times
    s_all = src.select(*cols)
    matched = gold.select(ident).join(hint(s_all), ident, "left_semi")
    fresh = s_all.join(hint(matched), ident, "left_anti")
    return gold_side.unionByName(fresh)

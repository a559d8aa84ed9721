"""Stage / gold reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.specs import FolderSpec


def read_layer(spark: SparkSession, path: str, spec: FolderSpec, kind: str = "stage",
               as_of=None) -> DataFrame:
    """A stage (``kind="stage"``, read-time retention applied with
    ``as_of``) or the current gold version (``kind="gold"``) at ``path``,
    always with the folder's declared schema (no inference)."""
    from tidemark.plans.storage import GoldStore, StageStore

    if kind == "stage":
        return StageStore(path, spec).read(spark, as_of)
    if kind == "gold":
        return GoldStore(path, spec).read(spark)
    raise ValueError(f"unknown layer kind {kind!r}")

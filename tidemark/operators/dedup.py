"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.specs import INGESTION_TS, SOURCE_FILE, FolderSpec


def _order(c: Column | str) -> Column:
    return c if isinstance(c, Column) else F.col(c).desc_nulls_last()


def latest_by_key(df: DataFrame, keys: str | Column | Sequence[str | Column],
                  order_col: str | Column = INGESTION_TS,
                  tie_breakers: Sequence[str | Column] = (),
                  rank_col: str = "_rn") -> DataFrame:
    """Keep the first row per key under ``order_col DESC NULLS LAST`` then
    ``tie_breakers`` (strings mean ``DESC NULLS LAST``).

    ``row_number() … = 1`` lets Catalyst plan a partial ``WindowGroupLimit``
    before the shuffle: each map task forwards at most one row per key, so a
    hot key costs one row per input partition in the exchange, not all its
    rows. NULL keys form one group (SQL semantics).
    """
    if isinstance(keys, (str, Column)):
        keys = [keys]
    w = Window.partitionBy(*keys).orderBy(
        _order(order_col), *[_order(c) for c in tie_breakers]
    )
    return (
        df.withColumn(rank_col, F.row_number().over(w))
        .filter(F.col(rank_col) == 1)
        .drop(rank_col)
    )


def tie_breakers(spec: FolderSpec) -> list[str]:
    """Deterministic order among rows with equal ``order_col``:
    ``source_file`` then the remaining row columns in table order, all
    descending, NULLs last."""
    rest = [c for c in spec.row_columns
            if c not in (spec.order_col, SOURCE_FILE, spec.key)]
    return [SOURCE_FILE] + rest


def latest_for_spec(df: DataFrame, spec: FolderSpec) -> DataFrame:
    """W1 for explicit folders (key column), W2 for payload folders
    (``_identity`` = canonical payload text must be present)."""
    return latest_by_key(df, spec.identity_col, spec.order_col, tie_breakers(spec))

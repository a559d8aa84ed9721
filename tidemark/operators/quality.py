"""Key gate (F6) and row type check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timestamps import is_blank, safe_date
from tidemark.operators.shape import REFUSED, REFUSED_RECORD
from tidemark.specs import FolderSpec

ERROR = "error"


def key_gate(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Split on ``key IS NULL``: (rows with a key, rows without + error).

    Gold's key is NOT NULL; a NULL-key row would fail the whole promotion,
    so it goes to the dead letter instead."""
    ok = df.filter(F.col(key).isNotNull())
    bad = df.filter(F.col(key).isNull()).withColumn(
        ERROR, F.lit(f"missing key: {key} is NULL")
    )
    return ok, bad


def with_type_errors(raw: DataFrame, spec: FolderSpec) -> DataFrame:
    """Add typed values for the DATE columns and an ``error`` text listing
    every value the table would refuse (non-empty text that is not a date).
    All built-in expressions (``concat_ws`` skips the NULLs), so the check
    stays inside whole-stage codegen."""
    msgs = [F.col(REFUSED)] if REFUSED in raw.columns else []
    out = raw
    for c, t in spec.typed_columns:
        if t != "DATE":
            continue  # TIMESTAMP columns are already typed (malformed → NULL)
        typed = safe_date(F.col(c))
        out = out.withColumn(f"_typed_{c}", typed)
        bad = ~is_blank(c) & F.col(f"_typed_{c}").isNull()
        msgs.append(F.when(bad, F.concat(F.lit(f"invalid DATE for {c}: '"), F.col(c), F.lit("'"))))
    err = F.nullif(F.concat_ws("; ", *msgs), F.lit("")) if msgs else F.lit(None).cast("string")
    return out.withColumn(ERROR, err)


def split_rejects(raw: DataFrame, spec: FolderSpec, cache: bool = False
                  ) -> tuple[DataFrame, DataFrame]:
    """(typed rows, rejected raw rows + ``error``).

    ``raw`` holds the business columns as text (TIMESTAMP columns already
    typed). A row is rejected when a non-empty DATE text does not parse;
    the raw text is kept in the reject so the dead letter shows it. A record
    that could not be shaped keeps its whole text in ``REFUSED_RECORD``.

    With ``cache`` the checked rows are persisted (memory, spilling to disk)
    so both outputs read one computation; otherwise the optimizer pushes each
    filter below the JSON parse and repeats it. Unpersist via
    ``good.unpersist()`` is not enough: call ``release_checked(good)``."""
    checked = with_type_errors(raw, spec)
    if cache:
        from pyspark import StorageLevel

        checked = checked.persist(StorageLevel.MEMORY_AND_DISK)
    typed_cols = {c for c, t in spec.typed_columns if t == "DATE"}
    keep = [c for c in raw.columns if c != REFUSED]
    good = checked.filter(F.col(ERROR).isNull()).select(
        *[F.col(f"_typed_{c}").alias(c) if c in typed_cols else F.col(c) for c in keep if c != REFUSED_RECORD]
    )
    bad = checked.filter(F.col(ERROR).isNotNull()).select(*keep, ERROR)
    good._checked = bad._checked = checked  # handle for release_checked
    return good, bad


def release_checked(df: DataFrame) -> None:
    """Drop the cache behind a ``split_rejects(..., cache=True)`` output."""
    checked = getattr(df, "_checked", None)
    if checked is not None:
        checked.unpersist()

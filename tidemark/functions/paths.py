"""Object naming helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def folder_of(name: Column | str) -> Column:
    """First path segment of an object name (``Order_Events/x.json.gz``)."""
    return F.split(_c(name), "/", 2).getItem(0)


def relative_name(path: Column | str, root: str) -> Column:
    """Object name relative to ``root`` (scheme-insensitive).

    ``binaryFile`` reports ``file:/a/b`` for a root given as ``/a`` and keeps
    ``s3a://bucket/a/b`` as is; both are reduced to ``b``.
    """
    r = root.rstrip("/")
    r_noscheme = r.split(":", 1)[1] if "://" in r or r.startswith("file:") else r
    r_noscheme = r_noscheme.lstrip("/")
    p = F.regexp_replace(_c(path), r"^[A-Za-z][A-Za-z0-9+.-]*:/*", "")
    # strip "<root>/" from the front, whatever the number of leading slashes
    pref = r_noscheme.rstrip("/") + "/"
    return F.when(F.startswith(p, F.lit(pref)), F.substring(p, len(pref) + 1, 1 << 30)).otherwise(p)


def object_uri(bucket: Column | str, name: Column | str, scheme: str = "gs") -> Column:
    return F.concat(F.lit(f"{scheme}://"), _c(bucket), F.lit("/"), _c(name))


def has_suffix(name: Column | str, suffix: str) -> Column:
    return F.endswith(_c(name), F.lit(suffix))

"""Scalar helpers; all are built-in Catalyst expressions."""

from tidemark.functions.jsonfn import canonical_json, json_value
from tidemark.functions.paths import folder_of, has_suffix, object_uri, relative_name
from tidemark.functions.timestamps import is_blank, safe_date, safe_timestamp

__all__ = [
    "canonical_json", "json_value", "folder_of", "has_suffix", "object_uri",
    "relative_name", "is_blank", "safe_date", "safe_timestamp",
]

"""Operators: decode, shape, route, quality, dedup, merge, views, dead letters."""

from tidemark.operators.deadletter import (
    fanout_dead_letters, file_dead_letters, row_dead_letters, union_dead_letters,
    write_dead_letters,
)
from tidemark.operators.decode import decode_blob, decode_objects, decode_paths
from tidemark.operators.dedup import latest_by_key, latest_for_spec, tie_breakers
from tidemark.operators.merge import merge_actions, merge_insert_only, merge_plan, merge_upsert
from tidemark.operators.quality import key_gate, split_rejects
from tidemark.operators.route import extract_object_path, route_by_folder, split_by_tag
from tidemark.operators.shape import (
    project_explicit, stage_rows, with_partition_date, with_provenance, wrap_payload,
)
from tidemark.operators.views import stage_window, union_layers, unified_view

__all__ = [
    "fanout_dead_letters", "file_dead_letters", "row_dead_letters", "union_dead_letters",
    "write_dead_letters", "decode_blob", "decode_objects", "decode_paths", "latest_by_key",
    "latest_for_spec", "tie_breakers", "merge_actions", "merge_insert_only", "merge_plan",
    "merge_upsert", "key_gate", "split_rejects", "extract_object_path", "route_by_folder",
    "split_by_tag", "project_explicit", "stage_rows", "with_partition_date", "with_provenance",
    "wrap_payload", "stage_window", "union_layers", "unified_view",
]

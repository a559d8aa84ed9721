"""Sources: object listings and streams, notifications, stage/gold layers."""

from tidemark.sources.layers import read_layer
from tidemark.sources.notifications import NOTIFICATION_SCHEMA, read_notifications
from tidemark.sources.objects import (
    BINARY_FILE_SCHEMA, filter_listing, list_changed, list_objects, lookback_cutoff,
    parse_execution_date, stream_objects,
)

__all__ = [
    "NOTIFICATION_SCHEMA", "read_notifications", "BINARY_FILE_SCHEMA",
    "filter_listing", "list_changed", "list_objects", "lookback_cutoff", "parse_execution_date",
    "stream_objects", "read_layer",
]

"""Folder registry and table contracts.

One ``FolderSpec`` per source folder describes everything derived from it:
stage / gold table names, the record shape (explicit columns or one JSON
payload), the dedup key, the ordering column and the lookback windows.
Onboarding a folder is adding one spec (see ``register``).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

EXPLICIT = "explicit"
PAYLOAD = "payload"

# ---------------------------------------------------------------------------
# Fixed values that must equal the contract of the surveyed pipeline
# (column names, order and SQL types of the explicit Order_Events tables;
# folder and table names; lookback/retention days).
# ---------------------------------------------------------------------------
ORDER_EVENTS_FOLDER = "Order_Events"
ORDER_EVENTS_STAGE = "STG_Order_Events"
ORDER_EVENTS_GOLD = "Order_Events"
ORDER_EVENTS_KEY = "record_id"
ORDER_EVENTS_COLUMNS = [
    ("record_id", "STRING"),
    ("order_date", "DATE"),
    ("ship_date", "DATE"),
    ("order_ref", "STRING"),
    ("source_code", "STRING"),
    ("category", "STRING"),
    ("status", "STRING"),
    ("channel", "STRING"),
    ("event_timestamp", "TIMESTAMP"),
    ("customer_name", "STRING"),
    ("region_code", "STRING"),
    ("contact_email", "STRING"),
]
NOTIFICATION_EVENTS_FOLDER = "Notification_Events"
NOTIFICATION_EVENTS_STAGE = "STG_Notification_Events"
NOTIFICATION_EVENTS_GOLD = "Notification_Events"
HOURLY_MERGE_DAYS = 1
DAILY_MERGE_DAYS = 2
EXPLICIT_VIEW_DAYS = 2
PAYLOAD_VIEW_DAYS = 1
STAGE_RETENTION_DAYS = 7
REPROCESS_DAYS = 2
OBJECT_SUFFIX = ".json.gz"
# ---------------------------------------------------------------------------

SOURCE_FILE = "source_file"
INGESTION_TS = "ingestion_timestamp"
STAGE_PARTITION = "p_date"
PAYLOAD_PARTITION = "_partition_date"
LAST_UPDATED = "_last_updated"
INGEST_BATCH = "ingest_batch"

_SQL_TYPES = {
    "STRING": T.StringType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
}


@dataclass(frozen=True)
class FolderSpec:
    """Contract of one source folder."""

    folder: str
    stage_table: str
    gold_table: str
    schema_type: str = EXPLICIT
    key: str | None = None
    columns: tuple[tuple[str, str], ...] = ()
    order_col: str = INGESTION_TS
    hourly_days: int = HOURLY_MERGE_DAYS
    daily_days: int = DAILY_MERGE_DAYS
    view_days: int = EXPLICIT_VIEW_DAYS
    retention_days: int = STAGE_RETENTION_DAYS
    extra: dict = field(default_factory=dict, compare=False)

    def __post_init__(self):
        if self.schema_type not in (EXPLICIT, PAYLOAD):
            raise ValueError(f"schema_type must be {EXPLICIT!r} or {PAYLOAD!r}, not {self.schema_type!r}")
        if self.schema_type == EXPLICIT and (not self.key or not self.columns):
            raise ValueError("explicit folders need a key and columns")

    # -- explicit -----------------------------------------------------------
    @property
    def business_columns(self) -> list[str]:
        if self.schema_type == PAYLOAD:
            return ["payload"]
        return [c for c, _ in self.columns]

    @property
    def typed_columns(self) -> list[tuple[str, str]]:
        return [(c, t) for c, t in self.columns if t != "STRING"]

    @property
    def row_columns(self) -> list[str]:
        """Columns of a stage/gold row, in table order (no partition column)."""
        if self.schema_type == PAYLOAD:
            return ["payload", SOURCE_FILE, INGESTION_TS]
        return self.business_columns + [SOURCE_FILE, INGESTION_TS]

    @property
    def partition_col(self) -> str:
        return STAGE_PARTITION if self.schema_type == EXPLICIT else PAYLOAD_PARTITION

    @property
    def identity_col(self) -> str:
        """Column whose value identifies a row for dedup and merge."""
        return self.key if self.schema_type == EXPLICIT else "_identity"

    def row_schema(self) -> T.StructType:
        if self.schema_type == PAYLOAD:
            fields = [T.StructField("payload", T.StringType(), False)]
        else:
            fields = [
                T.StructField(c, _SQL_TYPES[t], True) for c, t in self.columns
            ]
        fields += [
            T.StructField(SOURCE_FILE, T.StringType(), True),
            T.StructField(INGESTION_TS, T.TimestampType(), True),
        ]
        return T.StructType(fields)

    def stage_schema(self) -> T.StructType:
        s = self.row_schema()
        return T.StructType(
            s.fields + [T.StructField(self.partition_col, T.DateType(), False)]
        )

    def gold_schema(self) -> T.StructType:
        s = self.row_schema()
        if self.schema_type == PAYLOAD:
            return T.StructType(
                s.fields + [T.StructField(LAST_UPDATED, T.TimestampType(), True)]
            )
        return s

    def raw_schema(self) -> T.StructType:
        """All-STRING shape used between decode and the type check."""
        return T.StructType(
            [T.StructField(c, T.StringType(), True) for c in self.business_columns]
        )


ORDER_EVENTS = FolderSpec(
    folder=ORDER_EVENTS_FOLDER,
    stage_table=ORDER_EVENTS_STAGE,
    gold_table=ORDER_EVENTS_GOLD,
    schema_type=EXPLICIT,
    key=ORDER_EVENTS_KEY,
    columns=tuple(ORDER_EVENTS_COLUMNS),
    view_days=EXPLICIT_VIEW_DAYS,
)

NOTIFICATION_EVENTS = FolderSpec(
    folder=NOTIFICATION_EVENTS_FOLDER,
    stage_table=NOTIFICATION_EVENTS_STAGE,
    gold_table=NOTIFICATION_EVENTS_GOLD,
    schema_type=PAYLOAD,
    view_days=PAYLOAD_VIEW_DAYS,
)


class Registry:
    """Ordered folder → spec map."""

    def __init__(self, specs=()):
        self._specs: dict[str, FolderSpec] = {}
        for s in specs:
            self.register(s)

    def register(self, spec: FolderSpec) -> "Registry":
        self._specs[spec.folder] = spec
        return self

    def get(self, folder: str) -> FolderSpec | None:
        return self._specs.get(folder)

    def __iter__(self):
        return iter(self._specs.values())

    def __len__(self):
        return len(self._specs)

    def folders(self) -> list[str]:
        return list(self._specs)


def default_registry(include_payload: bool = True) -> Registry:
    specs = [ORDER_EVENTS] + ([NOTIFICATION_EVENTS] if include_payload else [])
    return Registry(specs)


# Dead-letter table.
DEAD_LETTER_SCHEMA = T.StructType(
    [
        T.StructField("subscription_name", T.StringType(), True),
        T.StructField("message_id", T.StringType(), True),
        T.StructField("publish_time", T.TimestampType(), True),
        T.StructField("attributes", T.StringType(), True),
        T.StructField("data", T.StringType(), True),
    ]
)
DEAD_LETTER_PARTITION = "publish_date"

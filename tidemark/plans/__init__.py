"""Plans: storage layout and end-to-end batch jobs."""

from tidemark.plans.jobs import PipelineConfig, daily_reprocess, hourly_merge, merge_folder
from tidemark.plans.storage import (
    CatalogGoldStore, GoldStore, StageStore, append_stage, create_tables, expire_partitions,
    write_bucketed,
)

__all__ = ["PipelineConfig", "daily_reprocess", "hourly_merge", "merge_folder",
           "CatalogGoldStore", "GoldStore", "StageStore", "append_stage", "create_tables",
           "expire_partitions", "write_bucketed"]

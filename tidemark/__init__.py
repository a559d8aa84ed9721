"""tidemark — Spark-native ingest, dedupe and upsert for stage → gold tables."""

__version__ = "0.1.0"

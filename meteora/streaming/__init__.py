"""Incremental ingestion of newly arrived yearly files (Structured Streaming)."""

from meteora.streaming.ingest import ingest_available, ingest_with_ledger, observation_stream

__all__ = ["ingest_available", "ingest_with_ledger", "observation_stream"]

"""Streaming: incremental landed-page ingestion (file source → raw table), and
fact and aggregates kept up by it."""

from tunestats.streaming.ingest import ingest, ingest_all, stream_raw  # noqa: F401
from tunestats.streaming.live import keep_up  # noqa: F401

"""Streaming ingest, per-batch statistics and real-time scoring."""

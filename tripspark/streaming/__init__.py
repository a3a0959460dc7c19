"""Structured Streaming forms: incremental Bronze ingest (file stream,
idempotent per micro-batch) and micro-batch scoring (exactly-once sink)."""

"""Structured Streaming jobs: idempotent incremental loading of star tables."""

from salesnet.streaming.ingest import append_new_keys, start_idempotent_load

__all__ = ["append_new_keys", "start_idempotent_load"]

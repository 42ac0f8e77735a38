"""Structured Streaming: incremental keyed loads with checkpointed offsets."""

from civitas.streaming.incremental import incremental_upsert  # noqa: F401

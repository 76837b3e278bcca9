"""Incremental mode: consume newly landed shards with Structured Streaming."""

from tackroom.streaming.incremental import incremental_shards, incremental_upsert, shard_stream, upsert_batch

__all__ = ["incremental_shards", "incremental_upsert", "shard_stream", "upsert_batch"]

"""Sources and sinks: NDJSON shards, staging, keyed target, snapshots."""

from tackroom.sources.ledger import consume, not_consumed, read_ledger
from tackroom.sources.shards import (
    read_shard_lines, discover_shards, merge_summary, write_master,
    write_batch_shards, write_cleaned, shard_file_name,
)
from tackroom.sources.tables import (
    load_staging, read_target, write_target, latest_version,
    write_snapshot, read_snapshot, snapshot_suffix, read_instances,
)

__all__ = [
    "read_shard_lines", "discover_shards", "merge_summary", "write_master",
    "write_batch_shards", "write_cleaned", "consume", "not_consumed", "read_ledger",
    "shard_file_name", "load_staging", "read_target", "write_target",
    "latest_version", "write_snapshot", "read_snapshot", "snapshot_suffix",
    "read_instances",
]

"""Session settings the plans of this package are written for."""

from __future__ import annotations

_MIB = 1 << 20
_SHUFFLE_BYTES = 256 * _MIB


def settings(largest_table_bytes: int, cores: int) -> dict[str, str]:
    """Spark settings for a cluster with `cores` task slots.

    The number of shuffle partitions follows the largest table, so that one
    partition fits in the memory of a task; adaptive execution merges those that
    turn out small and splits those of a join that turn out large.  The caller
    sets `spark.checkpoint.dir` to a folder all executors share.
    """
    partitions = max(largest_table_bytes // _SHUFFLE_BYTES, cores)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{_SHUFFLE_BYTES // 2}",
        "spark.sql.files.maxPartitionBytes": f"{_SHUFFLE_BYTES}",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.session.timeZone": "UTC",
    }

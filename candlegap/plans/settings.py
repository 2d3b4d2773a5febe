"""Session settings sized to the input, as a plain dict the caller applies.

Nothing here touches a session: the caller owns it (``spark.conf.set`` for
each item, or ``--conf`` at submit time).
"""

from __future__ import annotations

import math

MB = 1 << 20


def recommended_settings(input_bytes: int, *, target_partition_mb: int = 128) -> dict[str, str]:
    """Shuffle and scan sizing for ``input_bytes`` of input.

    The initial shuffle partition count aims at ``target_partition_mb`` per
    partition before adaptive coalescing (so no task spills on the widest
    shuffle, the events -> bars aggregation); AQE then merges small
    partitions and splits skewed joins and rebalances at runtime. Scans read
    splits of the same size.

    ``requireAllClusterKeysForCoPartition=false`` lets a join on (pair, date)
    reuse inputs already hash-partitioned by pair (the output of the
    instrument windows) instead of shuffling both sides again by all join
    keys; pair keys have high cardinality, so this adds no skew.
    """
    parts = max(1, math.ceil(input_bytes / (target_partition_mb * MB)))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{target_partition_mb}m",
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": f"{target_partition_mb}m",
        "spark.sql.requireAllClusterKeysForCoPartition": "false",
        "spark.sql.session.timeZone": "UTC",
    }

"""Join helpers: broadcast only behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Upper bound for an explicit broadcast hint. Plan statistics for Parquet scans
# are on-disk sizes, which understate the in-memory size several times, so the
# limit is kept well below executor memory.
DEFAULT_BROADCAST_LIMIT = 16 * 1024 * 1024
# From here on a source's size is Spark's placeholder for one that it doesn't know.
UNKNOWN_BYTES = 1 << 60


def estimated_size_bytes(df: DataFrame) -> int | None:
    """Optimizer size estimate of ``df`` (None where the plan is not reachable)."""
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
        return int(str(stats.sizeInBytes()))  # a number or a BigInt, by the version of the bridge
    except Exception:  # Spark Connect or a plan without statistics
        return None


def input_size_bytes(df: DataFrame) -> int | None:
    """Bytes that the plan of ``df`` reads, summed over its sources (None if one is unknown).
    The estimate of a join multiplies its sides; where work is dealt out by size, that would
    deal it out far too finely."""
    try:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    except Exception:
        return None
    return sum(sizes) if all(n < UNKNOWN_BYTES for n in sizes) else None


def sized_broadcast(df: DataFrame, limit_bytes: int = DEFAULT_BROADCAST_LIMIT) -> DataFrame:
    """Hint ``df`` for broadcast when its estimated size is at most ``limit_bytes``.

    Beyond the limit (or without an estimate) the frame is returned unchanged:
    the join then shuffles both sides, and AQE may still switch to a broadcast
    join if the runtime size of the materialised side turns out small.
    """
    size = estimated_size_bytes(df)
    if size is not None and size <= limit_bytes:
        return F.broadcast(df)
    return df

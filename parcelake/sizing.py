"""Decisions that depend on how large the data is, from Catalyst's own estimates.

An estimate comes from the file sizes Spark has already listed; nothing is run for it.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# A lookup side is broadcast only if its rows are estimated to take less than this in memory.
BROADCAST_BYTES = 64 * 1024 * 1024
# Estimates are of compressed and pruned files; as hashed rows they are several times larger.
ROW_BYTES_PER_FILE_BYTE = 8

# Files of this size fill one shuffle partition: about 200 MB of rows once decompressed.
FILE_BYTES_PER_PARTITION = 64 * 1024 * 1024
UNKNOWN_BYTES = 1 << 60         # Spark reports unknown sizes as about 2**63


def estimated_bytes(df: DataFrame) -> int:
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def fits_broadcast(df: DataFrame, limit: int | None = None) -> bool:
    rows = estimated_bytes(df) * ROW_BYTES_PER_FILE_BYTE
    return rows <= (BROADCAST_BYTES if limit is None else limit)


def scanned_bytes(df: DataFrame) -> int:
    """Bytes of everything `df` reads. An input of unknown size is an error, not nothing."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    if any(size >= UNKNOWN_BYTES for size in sizes):
        raise ValueError("the size of an input is unknown: write it as a table first")
    return sum(sizes)


@contextmanager
def shuffles_sized_for(spark: SparkSession, *scans: DataFrame) -> Iterator[int]:
    """Run the enclosed job with enough shuffle partitions for its input.

    Adaptive execution merges partitions that turn out small but never adds any, so the
    number has to be high enough from the start: the default of 200 would mean half a
    terabyte per task for 100 TB. It is never lowered below what the session has set.
    """
    key = "spark.sql.shuffle.partitions"
    before = int(spark.conf.get(key))
    wanted = -(-sum(scanned_bytes(df) for df in scans) // FILE_BYTES_PER_PARTITION)
    spark.conf.set(key, str(max(before, wanted)))
    try:
        yield max(before, wanted)
    finally:
        spark.conf.set(key, str(before))

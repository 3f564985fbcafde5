"""Session settings the builders are meant to run under."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Broadcast sizes are estimated from compressed files; count them as unpacked.
    "spark.sql.sources.fileCompressionFactor": "3.0",
    # Splits hot partitions of joins and rebalanced writes, and drops branches found empty.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Also where a grouping above the join reuses its partitioning and then needs a shuffle of its own.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A division by zero or a value too wide for its column must not pass silently.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


#: Bytes of input that make a shuffle one partition wider, and the widths it starts from and ends at.
BYTES_PER_PARTITION = 128 << 20
WIDTHS = (200, 1_000_000)


def shuffle_width(input_bytes: int) -> int:
    """Partitions a shuffle starts with; adaptive execution merges the small ones but cannot make more of them."""
    return min(max(WIDTHS[0], -(-input_bytes // BYTES_PER_PARTITION)), WIDTHS[1])


def with_settings(builder: SparkSession.Builder, input_bytes: int | None = None) -> SparkSession.Builder:
    """``input_bytes``: size of the raw tables unpacked, from which the width of the shuffles follows."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if input_bytes is not None:
        builder = builder.config("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(shuffle_width(input_bytes)))
    return builder

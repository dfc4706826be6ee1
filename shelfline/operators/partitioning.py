"""Partitioning helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def target_partitions(df: DataFrame) -> int:
    """The session's shuffle parallelism (sized per cluster in the job config)."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Fan out an under-split input before per-row work.

    An input with fewer partitions than the target (one large file with one
    row group, one archive decoded by one task) is rebalanced: adaptive
    execution picks the partition count from the data size (small data stays
    in few partitions, large data is split and skewed partitions are split
    further).  An input already split as wide is left alone, so no shuffle is
    added at scale.  Only call this on a scan or a narrow plan: counting the
    partitions of a plan with a shuffle would run it.
    """
    n = min_partitions or target_partitions(df)
    if df.rdd.getNumPartitions() >= n:
        return df
    return df.hint("rebalance")

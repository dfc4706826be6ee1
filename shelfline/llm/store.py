"""Intermediate tables in the cluster's shared folder, and row keys."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.session import ensure_checkpoint_dir, ship_package

# Rows per Arrow batch: a text row is a few KB, so a batch stays at a few MB.
ARROW_ROWS = "2000"


def prepare(spark: SparkSession) -> None:
    """Settings and shipped code that the Arrow operators rely on."""
    ensure_checkpoint_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    ship_package(spark)


def materialise(df: DataFrame) -> DataFrame:
    """Write a table once into the shared folder and read it back.

    The folder is the session's ``spark.checkpoint.dir`` (shared by driver and
    executors), so a lost executor loses none of it.  Unlike an RDD checkpoint
    the rows stay columnar, compressed and prunable.
    """
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fan_out(spark: SparkSession) -> int:
    """Tasks of a shuffle that feeds Python, sized like the session's shuffles."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)


def with_row_key(df: DataFrame, name: str) -> DataFrame:
    """Add a key that names each input row (also rows with equal or null ids).

    The key is the row's place in the scan, and how Spark splits a scan follows
    the cores that live at that time.  So the table is written once with its
    key, and whatever reads it later sees the same keys.
    """
    return materialise(df.withColumn(name, F.monotonically_increasing_id()))


def clear(df: DataFrame, *made: str) -> DataFrame:
    """Drop the columns whose names an operator is about to use.

    A column named like a result column gives way to the result; names that
    begin with two underscores are the operators' own.
    """
    taken = {m.lower() for m in made}
    return df.drop(*(c for c in df.columns if c.lower() in taken or c.startswith("__")))

"""Incremental ingest with Structured Streaming.

The file source over the archive folder replaces the "already present" list:
its checkpoint remembers which archives were ingested, and each micro-batch
runs the same ingest as the batch job (``plans.ingest.ingest_records``)
through ``foreachBatch``.  ``trigger(availableNow=True)`` processes what is
there and stops, so a scheduler can run it like the daily batch job.

Differences from the batch job: an archive is ingested once per file path
(the newest date is not redone on every run), and a corrupt archive is
skipped like in batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shelfline.plans.ingest import Nomenclatures, ingest_records
from shelfline.session import ship_package
from shelfline.sources.archives import archive_date, decode_archives


# Fixed layout of the binaryFile source.
BINARY_FILE = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
])


def start_archive_stream(spark: SparkSession, raw_dir: str, root: str, noms: Nomenclatures,
                         checkpoint_location: str, max_files_per_trigger: int | None = None,
                         available_now: bool = True) -> StreamingQuery:
    """Start the stream; with ``available_now`` it stops when caught up."""
    ship_package(spark)
    reader = (spark.readStream.format("binaryFile").schema(BINARY_FILE)
              .option("pathGlobFilter", "*.zip"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    archives = reader.load(raw_dir).select(archive_date(F.col("path")).alias("zip_date"), "content")

    def batch(df: DataFrame, epoch_id: int) -> None:
        # A replayed batch, or a stream with a new checkpoint folder, is a new
        # attempt with its own version; it replaces the same date partitions.
        ingest_records(df.sparkSession, decode_archives(df), root, noms, label=f"stream{epoch_id:08d}")

    writer = (archives.writeStream.foreachBatch(batch)
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 hour")
    return writer.start()

"""Token counts from flat, unindexed token files by separator scan.

A flat token file is a sequence of little-endian token ids; each document's
ids are followed by the end-of-document id, and nothing says where documents
begin.  A file is read as blocks cut anywhere.  Per block, a vectorised search
finds the separators; a prefix scan over the block summaries of a file (tokens,
separators and last separator so far) stitches documents that cross blocks.

Blocks are rows (file, block, data), so a file may have any length; the scan
orders small summary rows, per stride of blocks and then per file.  ``write_blocks`` makes such files
from texts, ``read_files`` from flat binary files.

Defined cases: an empty document is two separators in a row (0 tokens); ids
after the last separator of a file are a document that is not terminated; a
null text is empty; a block may hold no separator or many, or be empty; a
block whose bytes are not whole ids raises; ids of documents may be of any type,
null or repeated (each row is a document); other columns of the documents do
not matter, whatever their names; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfline.llm import blocks as B
from shelfline.llm import store
from shelfline.llm.bpe import TextEncoder, read_ranks
from shelfline.sources.archive_ranges import arrow_rows, file_pieces

BLOCK_TOKENS = 1 << 18
STRIDE = 1 << 12  # blocks whose summaries one window task orders
ID_TYPE = "<u2"
PIECE_ROWS = 16  # pieces of a MB in an Arrow batch


def write_blocks(docs: DataFrame, ranks_path: str, pattern: str, end_id: int, text: str = "text", key: str = "doc_id",
                 block_tokens: int = BLOCK_TOKENS, id_type: str = ID_TYPE) -> DataFrame:
    """Encode texts into flat token files, one per task: rows (file, block, data, keys).

    Blocks are cut every ``block_tokens`` ids, anywhere.  ``keys`` lists the
    ids of the documents that end in the block, in order: the manifest that
    names the documents of a file (the scan does not read it).
    """
    spark = docs.sparkSession
    store.prepare(spark)
    shared = spark.sparkContext.broadcast(read_ranks(ranks_path))
    src = docs.select(F.col(key).alias("key"), F.col(text).alias("__text"),
                      F.spark_partition_id().cast("long").alias("file"))
    if end_id > np.iinfo(np.dtype(id_type)).max:
        raise ValueError("the end-of-document id does not fit the id type")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TextEncoder(shared.value, pattern)
        file, block, held, keys, kind = 0, 0, np.empty(0, np.dtype(id_type)), [], None

        def row(data: np.ndarray, own: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([file], pa.int64()), pa.array([block], pa.int64()), pa.array([data.tobytes()], pa.binary()),
                 pa.array([own], pa.list_(kind))], names=["file", "block", "data", "keys"])

        for rows, _, _ in B.slices(batches, "__text"):
            file, kind = rows.column(2)[0].as_py(), rows.column(0).type
            ids, offsets = encoder(rows.column(1).to_pylist())
            flat = np.full(len(ids) + rows.num_rows, end_id, dtype=np.dtype(id_type))
            owner = np.repeat(np.arange(rows.num_rows), np.diff(offsets))
            flat[np.arange(len(ids)) + owner] = ids
            ends = len(held) + offsets[1:] + np.arange(rows.num_rows)  # places of the separators
            keys += zip(ends.tolist(), rows.column(0).to_pylist(), strict=True)
            held = np.concatenate([held, flat])
            at = 0
            while len(held) - at >= block_tokens:
                own = [k for e, k in keys if e < at + block_tokens]
                keys = keys[len(own):]
                yield row(held[at: at + block_tokens], own)
                block, at = block + 1, at + block_tokens
            held, keys = held[at:], [(e - at, k) for e, k in keys]
        if len(held):
            yield row(held, [k for _, k in keys])

    return src.mapInArrow(run, f"file long, block long, data binary, keys array<{src.schema['key'].dataType.simpleString()}>")


def read_files(spark: SparkSession, path: str, block_tokens: int = BLOCK_TOKENS, id_type: str = ID_TYPE) -> DataFrame:
    """Blocks (file, block, data) of flat binary token files of any length (files of no bytes have none).

    The files are read by byte ranges, in pieces cut anywhere; a block is put
    together from the few pieces it overlaps.
    """
    width = np.dtype(id_type).itemsize * block_tokens
    with arrow_rows(spark, PIECE_ROWS):
        pieces = file_pieces(spark, [path])
    cut = pieces.select("path", "at", "data", F.expr(
        f"explode(sequence(at div {width}, (at + length(data) - 1) div {width}))").alias("block"))
    first = F.expr(f"greatest(block * {width} - at, 0L)")
    own = cut.withColumn("from", first).select(
        F.col("path").alias("file"), "block", (F.col("at") + F.col("from")).alias("at"),
        F.expr(f"substring(data, cast(from + 1 as int), cast((block + 1) * {width} - at - from as int))").alias("data"))
    whole = own.groupBy("file", "block").agg(F.sort_array(F.collect_list(F.struct("at", "data"))).alias("parts"))
    return whole.select("file", "block", F.aggregate("parts", F.lit(b""), lambda out, x: F.concat(out, x["data"])).alias("data"))


def _separators(end_id: int, id_type: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per block: number of ids and the places of the separators in it."""
        kind = np.dtype(id_type)
        for batch in batches:
            for i in range(batch.num_rows):
                data = batch.column(2)[i].as_buffer()
                if data is not None and data.size % kind.itemsize:
                    raise ValueError("a block does not hold whole ids")
                ids = np.frombuffer(data, dtype=kind) if data is not None else np.empty(0, kind)
                found = np.flatnonzero(ids == end_id).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1), batch.column(1).slice(i, 1), pa.array([len(ids)], pa.int64()),
                     pa.array([found], pa.list_(pa.int32()))], names=["file", "block", "n_ids", "ends"])
    return run


def scan(blocks: DataFrame, end_id: int, id_type: str = ID_TYPE) -> DataFrame:
    """Documents of flat token files: (file, ordinal, start, n_tokens, terminated).

    ``start`` is the place of the first id in the file; ``ordinal`` counts the
    file's documents from 0.
    """
    spark = blocks.sparkSession
    store.prepare(spark)
    kind = blocks.schema["file"].dataType.simpleString()
    found = store.materialise(blocks.select("file", F.col("block").cast("long"), "data").mapInArrow(
        _separators(end_id, id_type), f"file {kind}, block long, n_ids long, ends array<int>"))
    size = F.size("ends")
    summary = found.select("file", "block", F.floor(F.col("block") / STRIDE).alias("stride"), "n_ids",
                           size.cast("long").alias("n_ends"), F.when(size > 0, F.element_at("ends", -1).cast("long")).alias("end"))
    # Prefix scan in two levels: over the blocks of a stride, then over the strides of a file.
    own = W.partitionBy("file", "stride").orderBy("block")
    local = summary.withColumn("at", _before("n_ids", own)).withColumn("end", F.col("at") + F.col("end"))
    local = local.withColumns({"nth": _before("n_ends", own), "cut": F.max("end").over(_open(own))})
    total = local.groupBy("file", "stride").agg(F.sum("n_ids").alias("n_ids"), F.sum("n_ends").alias("n_ends"),
                                                F.max("end").alias("end"), F.max("block").alias("final"))
    whole = W.partitionBy("file").orderBy("stride")
    total = total.withColumn("base", _before("n_ids", whole)).withColumn("end", F.col("base") + F.col("end"))
    total = total.select("file", "stride", "base", _before("n_ends", whole).alias("docs"),
                         F.coalesce(F.max("end").over(_open(whole)), F.lit(-1)).alias("before"),
                         F.when(F.lead("stride").over(whole).isNull(), F.col("final")).alias("final"))
    start = local.join(total, ["file", "stride"]).select(
        "file", "block", (F.col("base") + F.col("at")).alias("base"), (F.col("docs") + F.col("nth")).alias("docs"),
        F.coalesce(F.col("base") + F.col("cut"), F.col("before")).alias("cut"),
        F.coalesce(F.col("block") == F.col("final"), F.lit(False)).alias("last"))
    joined = found.join(start, ["file", "block"])
    ended = joined.select("file", "docs", "base", "cut", "ends", F.posexplode("ends").alias("at", "end")).select(
        "file", (F.col("docs") + F.col("at")).alias("ordinal"),
        (F.when(F.col("at") == 0, F.col("cut"))
         .otherwise(F.col("base") + F.try_element_at("ends", F.greatest(F.col("at"), F.lit(1)))) + 1).alias("start"),
        (F.col("base") + F.col("end")).alias("stop"), F.lit(True).alias("terminated"))
    here = F.when(size > 0, F.col("base") + F.element_at("ends", -1)).otherwise(F.col("cut"))
    rest = joined.filter("last").select(
        "file", (F.col("docs") + size).alias("ordinal"), (here + 1).alias("start"),
        (F.col("base") + F.col("n_ids")).alias("stop"), F.lit(False).alias("terminated")).filter("stop > start")
    return ended.union(rest).select("file", F.col("ordinal").cast("long"), "start",
                                    (F.col("stop") - F.col("start")).alias("n_tokens"), "terminated")


def _open(window: W) -> W:
    return window.rowsBetween(W.unboundedPreceding, -1)


def _before(column: str, window: W) -> F.Column:
    """Sum over the rows before this one."""
    return F.coalesce(F.sum(column).over(_open(window)), F.lit(0))


def manifest(blocks: DataFrame) -> DataFrame:
    """(file, ordinal, key) of the documents that ``write_blocks`` wrote.

    A block's first ordinal is a prefix sum in two levels, as in ``scan``; the
    keys themselves pass no window.
    """
    sized = blocks.select("file", "block", F.floor(F.col("block") / STRIDE).alias("stride"), F.size("keys").alias("n"))
    local = sized.withColumn("nth", _before("n", W.partitionBy("file", "stride").orderBy("block")))
    total = sized.groupBy("file", "stride").agg(F.sum("n").alias("n"))
    total = total.select("file", "stride", _before("n", W.partitionBy("file").orderBy("stride")).alias("docs"))
    start = local.join(total, ["file", "stride"]).select("file", "block", (F.col("docs") + F.col("nth")).alias("docs"))
    return blocks.select("file", "block", "keys").join(start, ["file", "block"]).select(
        "file", "docs", F.posexplode("keys").alias("at", "key")).select(
        "file", (F.col("docs") + F.col("at")).cast("long").alias("ordinal"), "key")

"""Large archives by byte ranges: no task holds an archive or a member.

``archives.scan_archives`` gives an archive up to a size to one task.  Larger
ones come here, in four jobs whose tasks hold a few MB each:

1. ``file_pieces``: the files are read by Spark's splittable line reader, as
   bytes; a prefix sum over the splits tells where each piece lies.
2. ``directories``: the last pieces of every archive give its central
   directory.  One that begins before them is read again from where it begins.
3. ``member_blocks``: neighbouring members form groups of about
   ``GROUP_BYTES``; a task has a group's pieces in order, inflates them as a
   stream, and verifies sizes and checksums of each member.  CSV members leave
   it as blocks of whole lines.
4. An archive counts only if its directory and all its members, of any kind,
   are whole.  Otherwise it is reported as corrupt and gives nothing.

A deflated member is one stream, so one task inflates it, in bounded memory;
its lines are tokenised by many (``csv_ranges``).
"""

from __future__ import annotations

import bz2
import contextlib
import io
import re
import struct
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.operators.joins import SizedFrame
from shelfline.session import write_once

PIECE_BYTES = 1 << 20
TAIL_BYTES = 1 << 20
GROUP_BYTES = 4 << 20
BLOCK_BYTES = 4 << 20
_STEP = 1 << 18
_OPEN_BYTES = 1 << 16
_GATHERED_ROWS = 1000
_LOCAL = struct.Struct("<4s5H3L2H")

_PIECES = "path string, size long, split long, rel long, data binary"
_ENTRY = ("path string, status string, need long, file_seq long, name string, raw_name binary, method int, encrypted boolean, "
          "crc long, packed long, size long, start long, stop long")
BLOCK = ("path string, kind string, file_seq long, file_name string, block long, delimiter string, ok boolean, content binary")

# What damaged data makes the decoders raise.
DAMAGED = (zipfile.BadZipFile, zlib.error, OSError, EOFError, ValueError, RuntimeError, NotImplementedError, struct.error)


@contextlib.contextmanager
def _setting(spark: SparkSession, key: str, value: int):
    before = spark.conf.get(key)
    spark.conf.set(key, str(value))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def arrow_rows(spark: SparkSession, rows: int):
    """Fewer rows per Arrow batch while rows of about a MB pass through Python."""
    return _setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def many_files(spark: SparkSession):
    """Many small files a task: opening one counts as little as it costs (by default as 4 MB of data)."""
    return _setting(spark, "spark.sql.files.openCostInBytes", _OPEN_BYTES)


def _gathered(rows: Iterator[tuple], fields: dict[str, pa.DataType]) -> Iterator[pa.RecordBatch]:
    """Rows as batches of a few MB: a batch of its own for every small row costs more than the row."""
    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), fields.values(), strict=True)], names=list(fields))

    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row if isinstance(x, bytes))
        if size >= BLOCK_BYTES or len(held) >= _GATHERED_ROWS:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


# ---------------------------------------------------------------------------
# 1. Pieces
# ---------------------------------------------------------------------------

def _join_lines(piece_bytes: int):
    fields = {"path": pa.string(), "size": pa.int64(), "split": pa.int64(), "rel": pa.int64(), "data": pa.binary()}

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """Lines of a split -> pieces with their place behind the split's first line."""
        where, rel, held, size = None, 0, [], 0

        def flush():
            return (*where, rel, b"".join(held))

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for path, length, split, line in zip(*columns, strict=True):
                if (path, length, split) != where:
                    if held:
                        yield flush()
                    where, rel, held, size = (path, length, split), 0, [], 0
                for at in range(0, len(line) + 1, piece_bytes):  # (+ 1: the line end, which may stand alone)
                    held.append(line[at: at + piece_bytes] if at + piece_bytes <= len(line) else line[at:] + b"\n")
                    size += len(held[-1])
                    if size >= piece_bytes:
                        yield flush()
                        rel, held, size = rel + size, [], 0
        if held:
            yield flush()
    return lambda batches: _gathered(pieces(batches), fields)


def file_pieces(spark: SparkSession, paths: list[str], piece_bytes: int = PIECE_BYTES, name_filter: str = "*",
                over_bytes: int = 0) -> DataFrame:
    """(path, size, at, data): every byte of the files, in pieces of about ``piece_bytes``.

    ``paths`` are files or folders, of which files of ``name_filter`` with more than ``over_bytes`` are read.

    The line reader only serves as a splittable byte reader: lines end at each
    byte 10, and their bytes come as they are.  What a split reads begins where
    the one before it ended, so places are prefix sums over the splits.
    """
    meta = F.col("_metadata")
    lines = spark.read.option("lineSep", "\n").option("pathGlobFilter", name_filter).text(paths).filter(
        meta["file_size"] > over_bytes).select(
        meta["file_path"].alias("path"), meta["file_size"].alias("size"), meta["file_block_start"].alias("split"),
        F.col("value").cast("binary").alias("line"))
    with many_files(spark):
        pieces = write_once(lines.mapInArrow(_join_lines(piece_bytes), _PIECES))
    # Per split one row: the scan is over as many rows as the files have splits.
    total = pieces.groupBy("path", "split").agg(F.sum(F.length("data")).alias("bytes"))
    before = F.expr("sum(bytes) OVER (PARTITION BY path ORDER BY split ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
    # What a file's first split reads begins at 0, so files of one split move for no join.
    base = write_once(total.select("path", "split", F.coalesce(before, F.lit(0)).alias("base")).filter("split > 0"))
    at = F.coalesce("base", F.lit(0)) + F.col("rel")
    # A last line without an end has got one too many.
    data = F.expr("substring(data, 1, CAST(least(length(data), size - at) AS INT))")
    return (pieces.join(SizedFrame(base).for_join(), ["path", "split"], "left").withColumn("at", at)
            .select("path", "size", "at", data.alias("data")).filter(F.length("data") > 0))


# ---------------------------------------------------------------------------
# 2. Directories
# ---------------------------------------------------------------------------

class _Missing(Exception):
    """A read before the bytes at hand."""


class _End(io.RawIOBase):
    """A file of which only the bytes from ``first`` on are at hand."""

    def __init__(self, size: int, first: int, data: bytes):
        self._size, self._first, self._data, self._at = size, first, data, 0

    def seekable(self) -> bool:
        return True

    def readable(self) -> bool:
        return True

    def seek(self, offset: int, whence: int = 0) -> int:
        self._at = offset + (0, self._at, self._size)[whence]
        if self._at < 0:
            raise OSError("before the file")
        return self._at

    def tell(self) -> int:
        return self._at

    def read(self, n: int = -1) -> bytes:
        end = self._size if n is None or n < 0 else min(self._at + n, self._size)
        if self._at < min(self._first, end):
            raise _Missing(self._at)
        out = self._data[self._at - self._first: max(end - self._first, 0)]
        self._at += len(out)
        return out


def entries(path: str, size: int, first: int, data: bytes) -> list[tuple]:
    """Directory rows of one archive from its last bytes: one per entry, or its status alone."""
    blank = (None,) * 10
    try:
        zf = zipfile.ZipFile(_End(size, first, data))
    except _Missing as e:
        return [(path, "cut", int(e.args[0]), *blank)]
    except DAMAGED:
        return [(path, "corrupt", None, *blank)]
    rows, seq, stop = [(path, "ok", None, *blank)], 0, zf.start_dir
    ends = {}
    for start in sorted({i.header_offset for i in zf.infolist()}, reverse=True):
        ends[start], stop = stop, start
    for i in zf.infolist():
        csv = i.filename.lower().endswith(".csv")
        name = i.orig_filename.encode("utf-8" if i.flag_bits & 0x800 else "cp437")
        rows.append((path, "entry", None, seq if csv else None, i.filename, name, i.compress_type, bool(i.flag_bits & 0x1),
                     i.CRC, i.compress_size, i.file_size, i.header_offset, ends[i.header_offset]))
        seq += csv
    return rows


def _read_directory(tail: pa.Table) -> pa.Table:
    tail = tail.sort_by("at")
    rows = entries(tail["path"][0].as_py(), tail["size"][0].as_py(), tail["at"][0].as_py(), b"".join(tail["data"].to_pylist()))
    schema = pa.schema([(f, t) for f, t in zip(
        ("path", "status", "need", "file_seq", "name", "raw_name", "method", "encrypted", "crc", "packed", "size", "start", "stop"),
        (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(),
         pa.int64(), pa.int64(), pa.int64()), strict=True)])
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)


def directories(pieces: DataFrame, tail_bytes: int = TAIL_BYTES) -> DataFrame:
    """One row per archive (ok, corrupt) and one per entry of the whole ones."""
    end = F.col("at") + F.length("data")
    first = write_once(pieces.filter(end > F.col("size") - tail_bytes).groupBy("path").applyInArrow(_read_directory, _ENTRY))
    cut = first.filter("status = 'cut'").select("path", "need")
    again = (pieces.join(SizedFrame(cut).for_join(), "path").filter(end > F.col("need")).drop("need")
             .groupBy("path").applyInArrow(_read_directory, _ENTRY))
    return write_once(first.filter("status <> 'cut'").union(again))


# ---------------------------------------------------------------------------
# 3. Members
# ---------------------------------------------------------------------------

_LINE_END = re.compile(rb"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e]|\xc2\x85|\xe2\x80[\xa8\xa9]")


def last_line_end(data: bytes) -> int:
    """Behind the last line end that can't go on in what follows; 0 if there is none."""
    cut = data.rfind(b"\n") + 1
    if cut:
        return cut
    for m in _LINE_END.finditer(data):
        if m.end() < len(data) or m[0] != b"\r":
            cut = m.end()
    return cut


class _Member:
    """One member's stream: bytes go in from its local header on, blocks of whole lines come out."""

    def __init__(self, row: dict, block_bytes: int):
        self.row, self.block_bytes, self.step = row, block_bytes, min(_STEP, block_bytes)
        self.head, self.left = b"", None  # local header so far; packed bytes still to come
        self.crc, self.size, self.ended = 0, 0, False
        self.pending, self.pending_size, self.block, self.delimiter = [], 0, 0, None
        self.broken = row["encrypted"] or row["method"] not in (0, 8, 12, 14)

    def _open(self) -> None:
        signature, *_, name, extra = _LOCAL.unpack(self.head[: _LOCAL.size])
        if len(self.head) < _LOCAL.size + name + extra:
            return
        if signature != b"PK\3\4" or self.head[_LOCAL.size: _LOCAL.size + name] != self.row["raw_name"]:
            raise zipfile.BadZipFile("local header")
        self.left = self.row["packed"]
        method = self.row["method"]
        self.decoder = (zlib.decompressobj(-15) if method == 8 else bz2.BZ2Decompressor() if method == 12
                        else zipfile.LZMADecompressor() if method == 14 else None)
        data, self.head = self.head[_LOCAL.size + name + extra:], b""
        self.packed = data

    def feed(self, data: bytes) -> Iterator[tuple[int, bytes]]:
        if self.broken:
            return
        try:
            if self.left is None:
                self.head += data
                if len(self.head) < _LOCAL.size:
                    return
                self._open()
                if self.left is None:
                    return
                data, self.packed = self.packed, b""
            data = data[: self.left]
            self.left -= len(data)
            for plain in self._inflate(data):
                if not plain:
                    continue
                self.crc = zlib.crc32(plain, self.crc)
                self.size += len(plain)
                if self.size > self.row["size"]:
                    raise zipfile.BadZipFile("size")
                if self.row["file_seq"] is not None:
                    self.pending.append(plain)
                    self.pending_size += len(plain)
                    if self.pending_size >= self.block_bytes:
                        yield from self._cut()
        except DAMAGED:
            self.broken = True

    def _inflate(self, data: bytes) -> Iterator[bytes]:
        method = self.row["method"]
        if method == 0:
            yield data
        elif method == 8:
            while data:
                yield self.decoder.decompress(data, self.step)  # bounded output, whatever the ratio
                data = self.decoder.unconsumed_tail
            if not self.left:
                yield self.decoder.flush()
        elif data and not self.decoder.eof:
            for at in range(0, len(data), 1 << 14):
                if not self.decoder.eof:
                    yield self.decoder.decompress(data[at: at + (1 << 14)])

    def _cut(self, all_of_it: bool = False) -> Iterator[tuple[int, bytes]]:
        data = b"".join(self.pending)
        at = len(data) if all_of_it else last_line_end(data)
        if not at and not all_of_it:
            self.pending = [data]  # one long line so far
            self.pending_size = 0  # look again after another block's worth
            return
        if self.block == 0:
            line = data.removeprefix(b"\xef\xbb\xbf")
            m = _LINE_END.search(line)
            line = line[: m.start()] if m else line
            self.delimiter = ";" if line.count(b";") > line.count(b",") else ","
        yield self.block, data[:at]
        self.block += 1
        self.pending, self.pending_size = [data[at:]], len(data) - at

    def close(self) -> Iterator[tuple[int, bytes]]:
        """The last block; afterwards ``ok`` tells whether the member was whole."""
        if self.row["file_seq"] is not None and not self.broken and (self.block == 0 or any(self.pending)):
            yield from self._cut(all_of_it=True)

    @property
    def ok(self) -> bool:
        return (not self.broken and self.left == 0 and self.size == self.row["size"] and self.crc == self.row["crc"])


def _inflate(block_bytes: int):
    fields = {"path": pa.string(), "kind": pa.string(), "file_seq": pa.int64(), "file_name": pa.string(), "block": pa.int64(),
              "delimiter": pa.string(), "ok": pa.bool_(), "content": pa.binary()}

    def blocks(members, found):
        for number, data in found:
            for m in members:
                yield m["path"], "block", m["file_seq"], m["name"], number, found_delimiter[0], None, data

    found_delimiter = [None]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """Rows come sorted by group, entries first, then pieces by place."""
        group, waiting, now, stream = None, [], [], None

        def feed(data):
            for number, block in stream.feed(data):
                found_delimiter[0] = stream.delimiter
                yield from blocks([m for m in now if m["file_seq"] is not None], [(number, block)])

        def end():
            for number, block in stream.close():
                found_delimiter[0] = stream.delimiter
                yield from blocks([m for m in now if m["file_seq"] is not None], [(number, block)])
            for m in now:
                yield m["path"], "verdict", m["file_seq"], m["name"], None, None, stream.ok, None

        def start():
            # Entries of the same place are one stream.
            first = waiting[0]["start"]
            same = [m for m in waiting if m["start"] == first]
            lead = next((m for m in same if m["file_seq"] is not None), same[0])
            return same, _Member(lead, block_bytes), [m for m in waiting if m["start"] != first]

        for batch in batches:
            for row in batch.to_pylist():
                here = (row["path"], row["group"])
                if here != group:
                    while stream is not None or waiting:
                        if stream is None:
                            now, stream, waiting = start()
                        yield from end()
                        stream = None
                    group = here
                if row["entry"] is not None:
                    waiting.append(row["entry"] | {"path": row["path"]})
                    continue
                at, data = row["at"], row["data"]
                while data:
                    if stream is None:
                        if not waiting or waiting[0]["start"] >= at + len(data):
                            break
                        skip = max(waiting[0]["start"] - at, 0)
                        at, data = at + skip, data[skip:]
                        now, stream, waiting = start()
                    take = data[: max(stream.row["stop"] - at, 0)]
                    if take:
                        yield from feed(take)
                    at, data = at + len(take), data[len(take):]
                    if at >= stream.row["stop"]:
                        yield from end()
                        stream = None
        while stream is not None or waiting:
            if stream is None:
                now, stream, waiting = start()
            yield from end()
            stream = None
    return lambda batches: _gathered(run(batches), fields)


def member_blocks(pieces: DataFrame, found: DataFrame, group_bytes: int = GROUP_BYTES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks of whole lines of every CSV member, and a verdict on every member (``BLOCK`` rows)."""
    spark = pieces.sparkSession
    rows = found.filter("status = 'entry'").withColumn("group", F.floor(F.col("start") / group_bytes))
    slot = lambda c: F.floor(c / group_bytes)
    spans = rows.groupBy("path", "group").agg(F.min("start").alias("lo"), F.max("stop").alias("hi"))
    last = F.greatest(F.col("hi") - 1, F.col("lo"))
    spans = spans.withColumn("first_slot", slot(F.col("lo"))).withColumn("slot", F.explode(F.sequence(slot(F.col("lo")), slot(last))))
    until = F.col("at") + F.length("data")
    mine = pieces.select("path", "at", "data", slot(F.col("at")).alias("own"),
                         F.explode(F.sequence(slot(F.col("at")), slot(until - 1))).alias("slot"))
    # A piece and a group may share several slots: they meet in the first of them.
    meet = mine.join(spans, ["path", "slot"]).filter(
        (F.col("slot") == F.greatest("own", "first_slot")) & (F.col("at") < F.col("hi")) & (until > F.col("lo")))
    entry = F.struct("file_seq", "name", "raw_name", "method", "encrypted", "crc", "packed", "size", "start", "stop")
    heads = rows.select("path", "group", F.col("start").alias("at"), F.lit(None).cast("binary").alias("data"), entry.alias("entry"))
    both = heads.unionByName(meet.select("path", "group", "at", "data", F.lit(None).cast(heads.schema["entry"].dataType).alias("entry")))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = both.repartition(parts, "path", "group").sortWithinPartitions(
        "path", "group", F.col("entry").isNull(), "at", F.col("entry.file_seq").asc_nulls_last())
    with arrow_rows(spark, 32):
        return write_once(dealt.mapInArrow(_inflate(block_bytes), BLOCK), "zstd")


def scan(spark: SparkSession, paths: list[str], date_of, piece_bytes: int = PIECE_BYTES, tail_bytes: int = TAIL_BYTES,
         group_bytes: int = GROUP_BYTES, block_bytes: int = BLOCK_BYTES, name_filter: str = "*", over_bytes: int = 0) -> DataFrame:
    """``RECORD_SCHEMA`` rows of the archives at ``paths``, all read by ranges.

    ``date_of(path column)`` is an archive's business date; of a folder, files of ``name_filter`` and more than ``over_bytes``.
    """
    from shelfline.sources import csv_ranges

    with arrow_rows(spark, 20_000):
        pieces = file_pieces(spark, paths, piece_bytes, name_filter, over_bytes)
    with arrow_rows(spark, 32):
        found = directories(pieces, tail_bytes)
    blocks = member_blocks(pieces, found, group_bytes, block_bytes)
    # Written, so that its size is known: blocks move for no join with a few paths.
    bad = SizedFrame(write_once(blocks.filter("kind = 'verdict' AND NOT ok").select("path")
                                .union(found.filter("status = 'corrupt'").select("path")).distinct())).for_join()
    archives = found.filter("status IN ('ok', 'corrupt')").select("path").join(
        bad.withColumn("bad", F.lit(True)), "path", "left")
    whole = blocks.filter("kind = 'block'").join(bad, "path", "left_anti")
    date = date_of(F.col("path"))
    heads = archive_rows(archives.select(date.alias("zip_date"), F.when(F.col("bad"), "corrupt").otherwise("ok").alias("status")))
    return heads.unionByName(csv_ranges.split_records(whole.select(
        date.alias("zip_date"), F.col("path").alias("source"), "file_seq", "file_name", "block", "delimiter", "content")))


def archive_rows(archives: DataFrame) -> DataFrame:
    """(zip_date, status) as ``RECORD_SCHEMA`` rows of kind ``archive``."""
    from shelfline.sources.archives import RECORD_SCHEMA

    given: dict[str, Column] = {"kind": F.lit("archive"), "zip_date": F.col("zip_date"), "status": F.col("status")}
    return archives.select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in RECORD_SCHEMA.fields])

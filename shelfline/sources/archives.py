"""Daily archives -> raw records.

Two steps, so that neither an archive nor the archives of a day are one task's
work beyond unzipping:

* ``archive_members`` opens each archive (a ``binaryFile`` row), reads all of
  it once to verify its checksums, and yields one row per CSV member with its
  bytes.  An archive that can't be read whole is reported (``status=corrupt``)
  and contributes nothing, so its existing partition is left alone;
* ``member_records`` tokenises one member as a stream with the standard CSV
  reader, since the delimiter is chosen per file from its header line.

This is the only Python of the ingest that runs on executors; everything after
it is built-in expressions.

Output rows (``RECORD_SCHEMA``) are of three kinds, told apart by ``kind``:

* ``archive`` - one per archive, with its status (``ok``, ``corrupt``);
* ``member``  - one per ``.csv`` member, with its delimiter and status
  (``ok``, ``empty``, ``undecodable``, ``malformed``);
* ``record``  - one per data line after the header, with the field count and
  the first seven fields (missing ones NULL).
"""

from __future__ import annotations

import csv
import io
import re
import sys
import zipfile
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.schemas import EXPECTED_COLUMNS, RAW_COLUMNS

RECORD_SCHEMA = T.StructType(
    [T.StructField("kind", T.StringType()),
     T.StructField("zip_date", T.StringType()),
     T.StructField("file_seq", T.LongType()),
     T.StructField("file_name", T.StringType()),
     T.StructField("delimiter", T.StringType()),
     T.StructField("status", T.StringType()),
     T.StructField("row_seq", T.LongType()),
     T.StructField("n_fields", T.IntegerType())]
    + [T.StructField(c, T.StringType()) for c in RAW_COLUMNS]
)

MEMBER_SCHEMA = T.StructType([
    T.StructField("zip_date", T.StringType()),
    T.StructField("file_seq", T.LongType()),
    T.StructField("file_name", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("content", T.BinaryType()),
])

_BATCH_ROWS = 20_000
_NO_FIELDS = (None,) * EXPECTED_COLUMNS
_LINE = re.compile("[^\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]*(?:\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029])?")
_ENDS = "\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"
# What an archive that is damaged anywhere makes the reader raise.
_DAMAGED = (zipfile.BadZipFile, zlib.error, OSError, EOFError, ValueError, RuntimeError, NotImplementedError)


def _delimiter(first_line: str) -> str:
    return ";" if first_line.count(";") > first_line.count(",") else ","


def _members(zip_date: str, content: bytes) -> Iterator[tuple]:
    """The archive row, then its CSV members; or a corrupt archive's row alone."""
    try:
        zf = zipfile.ZipFile(io.BytesIO(content))
        if zf.testzip() is not None:  # reads every member, checks every checksum
            raise zipfile.BadZipFile("checksum")
        names = [n for n in zf.namelist() if n.lower().endswith(".csv")]
    except _DAMAGED:
        yield zip_date, None, None, "corrupt", None
        return
    yield zip_date, None, None, "ok", None
    for file_seq, name in enumerate(names):
        yield zip_date, file_seq, name, "ok", zf.read(name)


def _unzip(batches):
    import pandas as pd

    for pdf in batches:
        for zip_date, content in zip(pdf["zip_date"], pdf["content"]):
            for row in _members(zip_date, content):
                out = pd.DataFrame([row], columns=MEMBER_SCHEMA.fieldNames())
                out["file_seq"] = out["file_seq"].astype("Int64")
                yield out


def _lines(text: str) -> Iterator[str]:
    """The text's lines without their ends, one at a time."""
    at = 0
    while at < len(text):
        m = _LINE.match(text, at)
        yield m[0].rstrip(_ENDS)
        at = m.end()


def _member_rows(zip_date: str, file_seq: int | None, name: str | None, status: str, content: bytes | None) -> Iterator[tuple]:
    """Rows of one member (see module docstring)."""
    if name is None:
        yield ("archive", zip_date, None, None, None, status, None, None) + _NO_FIELDS
        return
    file_seq = int(file_seq)

    def member(delimiter, state):
        return ("member", zip_date, file_seq, name, delimiter, state, None, None) + _NO_FIELDS

    try:
        text = content.decode("utf-8-sig")
    except UnicodeDecodeError:
        yield member(None, "undecodable")
        return
    header = next(_lines(text), None)
    if header is None:
        yield member(None, "empty")
        return
    delim = _delimiter(header)
    csv.field_size_limit(sys.maxsize)  # an unbalanced quote may swallow the rest of a file
    reader = csv.reader(_lines(text), delimiter=delim)
    try:
        next(reader, None)  # the header line is always dropped
        for row_seq, fields in enumerate(reader):
            head = list(fields[:EXPECTED_COLUMNS]) + [None] * (EXPECTED_COLUMNS - len(fields))
            yield ("record", zip_date, file_seq, name, delim, "ok", row_seq, len(fields), *head)
    except csv.Error:
        yield member(delim, "malformed")  # its lines up to here are kept
        return
    yield member(delim, "ok")


def _tokenise(batches):
    import pandas as pd

    cols = RECORD_SCHEMA.fieldNames()

    def frame(buf):
        out = pd.DataFrame(buf, columns=cols)
        for c in ("file_seq", "row_seq", "n_fields"):
            out[c] = out[c].astype("Int64")
        return out

    buf = []
    for pdf in batches:
        pdf = pdf.astype({"file_seq": "Int64"})
        for row in pdf.itertuples(index=False):
            seq = None if pd.isna(row.file_seq) else int(row.file_seq)
            for record in _member_rows(row.zip_date, seq, row.file_name, row.status, row.content):
                buf.append(record)
                if len(buf) >= _BATCH_ROWS:
                    yield frame(buf)
                    buf = []
    if buf:
        yield frame(buf)


def list_archives(spark: SparkSession, raw_dir: str) -> DataFrame:
    """``(path, zip_date)`` of every ``*.zip`` under ``raw_dir`` (no content read)."""
    df = (spark.read.format("binaryFile").option("pathGlobFilter", "*.zip")
          .load(raw_dir).select("path"))
    return df.select("path", archive_date(F.col("path")).alias("zip_date"))


def archive_date(path) -> "F.Column":
    """Business date of an archive = its file stem (``.../2026-04-01.zip``)."""
    return F.regexp_extract(path, r"([^/]+)\.zip$", 1)


def decode_archives(archives: DataFrame) -> DataFrame:
    """``(zip_date, content)`` of archives -> ``RECORD_SCHEMA`` rows.

    Members are dealt out again between the two steps, so the members of one
    archive are tokenised by several tasks.
    """
    members = archives.select("zip_date", "content").mapInPandas(_unzip, MEMBER_SCHEMA)
    return members.repartition(F.col("zip_date"), F.col("file_seq")).mapInPandas(_tokenise, RECORD_SCHEMA)


# Packed bytes up to which one task may hold an archive.
WHOLE_BYTES = 64 << 20


def scan_archives(spark: SparkSession, paths: str | list[str], whole_bytes: int = WHOLE_BYTES, date_of=archive_date,
                  name_filter: str = "*.zip", **ranges) -> DataFrame:
    """Decode archives into ``RECORD_SCHEMA`` rows.

    ``paths`` is a folder, or the files of the work list: only they are
    listed and read.  Archives of more than ``whole_bytes`` are read by byte
    ranges (``archive_ranges``, which ``ranges`` is handed to), with the same rows.
    """
    from shelfline.session import ship_package
    from shelfline.sources import archive_ranges

    ship_package(spark)
    paths = [paths] if isinstance(paths, str) else list(paths)
    df = spark.read.format("binaryFile").option("pathGlobFilter", name_filter).load(paths)
    # (Sizes come from the listing; contents of large files are never asked for.)
    with archive_ranges.many_files(spark):
        sizes = df.agg(F.count_if(F.col("length") > whole_bytes).alias("large"), F.count(F.lit(1)).alias("all")).first()
    small = decode_archives(df.filter(F.col("length") <= whole_bytes).select(date_of(F.col("path")).alias("zip_date"), "content"))
    if not sizes["large"]:
        return small
    found = archive_ranges.scan(spark, paths, date_of, name_filter=name_filter, over_bytes=whole_bytes, **ranges)
    return small.unionByName(found) if sizes["all"] > sizes["large"] else found

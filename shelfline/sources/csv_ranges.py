"""Records of CSV members that are cut into blocks of whole lines.

A quoted field may go on over line ends, so a block alone can't tell where its
first record begins.  But between two lines a reader is in one of two states,
inside quotes or not, and a block maps the state before it to the state behind
it.  Three steps:

1. every block is summarised for both states: the state behind it, and how many
   records begin in it;
2. a prefix scan over a member's summaries (a few numbers per block) gives each
   block its state and the number of its first record;
3. every block is tokenised from its state on.  Records that lie in it are done;
   lines of a record that began before it, or goes on behind it, are handed to
   that record, whose lines meet in a shuffle by record number.

A member is any number of tasks.  A task holds one block, or the lines of one
record that crosses blocks.  The result is the one of the standard CSV reader
over the member's lines (``archives``): an unbalanced quote takes in the rest
of the member, as it does there.
"""

from __future__ import annotations

import csv
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.operators.joins import SizedFrame
from shelfline.schemas import EXPECTED_COLUMNS, RAW_COLUMNS
from shelfline.session import write_once

_OUT, _IN = 0, 1
_QUOTE = '"'
_SUMMARY = ("zip_date string, source string, file_seq long, block long, valid boolean, lines long, after_out int, begun_out long, "
            "after_in int, begun_in long")
_PLACED = "zip_date string, source string, file_seq long, block long, before int, first long, valid boolean, lines long"
_PART = ("zip_date string, source string, file_seq long, file_name string, delimiter string, number long, block long, "
         "lines array<string>, n_fields int, fields array<string>")


def decode(content: bytes, block: int) -> str | None:
    """A block's text, without the mark that may begin a file; None where it is no UTF-8."""
    try:
        return content.decode("utf-8-sig" if block == 0 else "utf-8")
    except UnicodeDecodeError:
        return None


def parse(lines: list[str], delimiter: str, before: int) -> Iterator[tuple[int, int, list[str]]]:
    """(first line, line behind, fields) of every record; a record that is open at the end ends behind ``len(lines) + 1``.

    A lone quote before the lines puts the reader inside quotes; one behind
    them closes an open record, or is a record of its own.
    """
    csv.field_size_limit(sys.maxsize)
    lead = [_QUOTE] * before
    reader = csv.reader([*lead, *lines, _QUOTE], delimiter=delimiter)
    at = 0
    for fields in reader:
        end = reader.line_num
        if at == len(lead) + len(lines):
            return  # only the closing quote
        yield max(at - before, 0), end - before, fields
        at = end


def summary(lines: list[str], delimiter: str, before: int) -> tuple[int, int]:
    """State behind the lines, and records that begin in them."""
    if not any(_QUOTE in x for x in lines):
        return (before, 0 if before else len(lines))
    begun, end = 0, 0
    for _, end, _ in parse(lines, delimiter, before):
        begun += 1
    return (_IN if end > len(lines) else _OUT), begun - before


def tokenise(lines: list[str], delimiter: str, before: int, first: int) -> Iterator[tuple[int, list[str] | None, list[str] | None]]:
    """(record number, fields, None) of whole records; (record number, None, lines) of parts."""
    number = first - before
    for start, end, fields in parse(lines, delimiter, before):
        if (before and number == first - 1) or end > len(lines):
            yield number, None, lines[start:end]
        else:
            yield number, fields, None
        number += 1


def place(blocks: list[tuple[int, int, int, int]]) -> list[tuple[int, int]]:
    """(state, first record) before each block from its (after_out, begun_out, after_in, begun_in)."""
    state, number, out = _OUT, 0, []
    for after_out, begun_out, after_in, begun_in in blocks:
        out.append((state, number))
        state, number = (after_in, number + begun_in) if state else (after_out, number + begun_out)
    return out


def _text_lines(text: str) -> list[str]:
    """The lines of ``archives._lines``, at once."""
    return text.splitlines()


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["zip_date", "source", "file_seq", "block", "valid", "lines", "after_out", "begun_out", "after_in", "begun_in"]
    types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64()]
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            text = decode(r["content"], r["block"])
            lines = _text_lines(text or "")
            # (Nothing is before a member's first block, so it is never begun inside quotes.)
            rows.append((r["zip_date"], r["source"], r["file_seq"], r["block"], text is not None, len(lines),
                         *summary(lines, r["delimiter"], _OUT), *(summary(lines, r["delimiter"], _IN) if r["block"] else (_OUT, 0))))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def _scan_member(blocks: pa.Table) -> pa.Table:
    """The prefix scan over one member's summaries."""
    blocks = blocks.sort_by("block")
    found = place(list(zip(*(blocks[c].to_pylist() for c in ("after_out", "begun_out", "after_in", "begun_in")), strict=True)))
    n = blocks.num_rows
    valid = all(blocks["valid"].to_pylist())
    lines = sum(blocks["lines"].to_pylist())
    return blocks.select(["zip_date", "source", "file_seq", "block"]).append_column(
        "before", pa.array([s for s, _ in found], pa.int32())).append_column(
        "first", pa.array([i for _, i in found], pa.int64())).append_column(
        "valid", pa.array([valid] * n)).append_column("lines", pa.array([lines] * n, pa.int64()))


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    names = ["zip_date", "source", "file_seq", "file_name", "delimiter", "number", "block", "lines", "n_fields", "fields"]
    types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.int32(),
             pa.list_(pa.string())]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


_BATCH = 20_000


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole records, and parts of those that cross blocks."""
    head = {"zip_date": pa.string(), "source": pa.string(), "file_seq": pa.int64(), "file_name": pa.string(), "delimiter": pa.string(),
            "block": pa.int64()}
    blocks, numbers, parts, found = [], [], [], []

    def out() -> pa.RecordBatch:
        # What a block's records share is not told record by record.
        columns = {c: pa.concat_arrays([pa.repeat(pa.scalar(r[c], t), n) for r, n in blocks]) for c, t in head.items()}
        columns |= {"number": pa.array(numbers, pa.int64()), "lines": pa.array(parts, pa.list_(pa.string())),
                    "n_fields": pa.array([None if x is None else len(x) for x in found], pa.int32()),
                    "fields": pa.array([None if x is None else x[:EXPECTED_COLUMNS] for x in found], pa.list_(pa.string()))}
        order = ["zip_date", "source", "file_seq", "file_name", "delimiter", "number", "block", "lines", "n_fields", "fields"]
        return pa.RecordBatch.from_arrays([columns[c] for c in order], names=order)

    for batch in batches:
        for r in batch.to_pylist():
            lines = _text_lines(decode(r["content"], r["block"]))
            blocks.append((r, 0))
            at = len(numbers)
            for number, fields, part in tokenise(lines, r["delimiter"], r["before"], r["first"]):
                numbers.append(number)
                parts.append(part)
                found.append(fields)
                if len(numbers) >= _BATCH:
                    blocks[-1] = (r, len(numbers) - at)
                    yield out()
                    blocks, numbers, parts, found, at = [(r, 0)], [], [], [], 0
            blocks[-1] = ({c: r[c] for c in head}, len(numbers) - at)
    if numbers:
        yield out()


def _assemble(parts: pa.Table) -> pa.Table:
    """One record from its lines in all its blocks."""
    parts = parts.sort_by("block")
    csv.field_size_limit(sys.maxsize)
    lines = [x for part in parts["lines"].to_pylist() for x in part]
    (fields,) = csv.reader(lines, delimiter=parts["delimiter"][0].as_py())
    head = [parts[c][0].as_py() for c in ("zip_date", "source", "file_seq", "file_name", "delimiter", "number", "block")]
    return pa.Table.from_batches([_rows([(*head, None, len(fields), fields[:EXPECTED_COLUMNS])])])


def split_records(blocks: DataFrame) -> DataFrame:
    """``RECORD_SCHEMA`` rows (members, records) of (zip_date, source, file_seq, file_name, block, delimiter, content)."""
    from shelfline.sources.archive_ranges import arrow_rows
    from shelfline.sources.archives import RECORD_SCHEMA

    spark = blocks.sparkSession
    key = ["zip_date", "source", "file_seq"]
    with arrow_rows(spark, 32):
        told = write_once(blocks.select(*key, "block", "delimiter", "content").mapInArrow(_summaries, _SUMMARY))
        # A member of one block is not scanned: that would be a call for every small file.
        told = told.withColumn("_blocks", F.count(F.lit(1)).over(Window.partitionBy(*key)))
        scanned = told.filter("_blocks > 1").drop("_blocks").groupBy(*key).applyInArrow(_scan_member, _PLACED)
        alone = told.filter("_blocks = 1").select(*key, "block", F.lit(_OUT).alias("before"), F.lit(0).cast("long").alias("first"), "valid", "lines")
        placed = write_once(scanned.union(alone))
        known = blocks.join(SizedFrame(placed.filter("valid")).for_join(), [*key, "block"])
        parsed = write_once(known.select(*key, "file_name", "delimiter", "block", "content", "before", "first").mapInArrow(_records, _PART), "zstd")
    crossing = parsed.filter(F.col("lines").isNotNull()).groupBy(*key, "number").applyInArrow(_assemble, _PART)
    records = parsed.filter(F.col("lines").isNull()).union(crossing).filter("number > 0")  # the header is dropped
    members = blocks.filter("block = 0").join(placed.filter("block = 0"), [*key, "block"])
    state = F.when(~F.col("valid"), "undecodable").when(F.col("lines") == 0, "empty").otherwise("ok")
    types = {f.name: f.dataType for f in RECORD_SCHEMA.fields}

    def shaped(df, kind, **given):
        given = {"kind": F.lit(kind), **{c: F.col(c) for c in ("zip_date", "file_seq", "file_name")}, **given}
        return df.select(*[given.get(n, F.lit(None)).cast(t).alias(n) for n, t in types.items()])

    fields = {c: F.get("fields", F.lit(i)) for i, c in enumerate(RAW_COLUMNS)}
    return shaped(members, "member", status=state, delimiter=F.when(state == "ok", F.col("delimiter"))).unionByName(
        shaped(records, "record", status=F.lit("ok"), delimiter=F.col("delimiter"), row_seq=F.col("number") - 1,
               n_fields=F.col("n_fields"), **fields))

"""Exact repeated-substring removal by bucket-pointer refinement.

A byte is removed if a string of ``length`` bytes (400) that covers it also
starts anywhere else in the corpus.  Suffixes are sorted only as deep as
needed: to ``length`` bytes, and only where a repeat is possible.

1. Initial q-gram buckets.  Every string of ``length`` bytes is represented by
   its anchor: the q-gram (q = length / 2) of smallest hash in it, leftmost of
   equals.  Equal strings have equal anchors at equal places, so strings meet
   in the bucket of their anchor.  Consecutive strings with one anchor form a
   segment (at most ``length - q + 1`` of them): one row per segment, not per
   byte.  A bucket with one segment is sorted already: nothing there repeats.
2. Segments of a bucket with equal bytes are one class.  Strings of a class
   with two or more members repeat; nothing more is to be sorted for them.
3. What is left, one text per class, is refined: strings are bucketed by their
   first bytes, then the members of each bucket of two or more are sorted by
   the bucket identifiers of later offsets (p + depth), which doubles the
   depth, and the refined identifiers serve the next round, up to ``length``.
   Buckets of two or more at that depth are repeats.

A task refines whole anchor buckets, a few MB at a time.  An anchor bucket of
more than ``BUCKET_CLASSES`` classes is refined across tasks instead: its
strings become rows keyed by the identifiers of their two halves, counted by
a grouped (partially summed) aggregation.

Identifiers of byte ranges are 64-bit hashes; a wrong match needs a collision.

Defined cases: null is empty; texts shorter than ``length`` lose nothing;
matches never cross texts; rows that repeat a text or doc_id are texts of
their own (so they match each other); null doc_id is kept; empty tables give
empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from shelfline.llm import blocks as B
from shelfline.llm import store

LENGTH = 400
BUCKET_CLASSES = 2048
REFINE_BYTES = 4 << 20
_PLACE = np.uint64((1 << 24) - 1)
_STEP = 1 << 20


def segments(text: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Of one text: first string, strings, anchor hash and byte hash of each segment."""
    q = length // 2
    w = length - q + 1
    strings = len(text) - length + 1
    out = []
    for base in range(0, strings, _STEP):  # a long text is taken in steps, so memory is bounded
        here = min(_STEP, strings - base)
        rolling = B.RollingHash(text[base: base + here + length - 1])
        grams = rolling.grams(q)
        # Smallest by the hash's upper bits, then by place.
        least = B.window_min((grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64), w)[:here]
        anchor = (least & _PLACE).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        size = np.diff(np.append(first, len(anchor)))
        out.append((first + base, size, grams[anchor[first]], rolling.spans(first, first + size + length - 1)))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _segment_rows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, offsets in B.slices(batches, "__text"):
            key = rows.column(0).to_numpy()
            made = []
            for i in np.flatnonzero(np.diff(offsets) >= length):
                lo, n, anchor, body = segments(buf[offsets[i]: offsets[i + 1]], length)
                made.append((np.full(len(lo), key[i]), lo, n, anchor, body))
            if made:
                row, lo, n, anchor, body = (np.concatenate(x) for x in zip(*made, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row), pa.array(lo.astype(np.int32)), pa.array(n.astype(np.int32)),
                     pa.array(anchor.view(np.int64)), pa.array(body.view(np.int64))],
                    names=["row", "lo", "n", "anchor", "body"])
    return run


def refine(data: np.ndarray, begin: np.ndarray, strings: np.ndarray, length: int) -> np.ndarray:
    """Which strings occur twice or more among some segments.

    ``data`` holds the segments' bytes one after another; segment ``i`` starts
    at ``begin[i]`` and has ``strings[i]`` strings of ``length`` bytes.  The
    result has a flag per string, segment by segment.
    """
    q = length // 8
    reach = strings + length - 1  # bytes of each segment

    def places(depth: int) -> np.ndarray:
        """Positions whose first ``depth`` bytes lie in their segment."""
        have = reach - depth + 1
        return np.repeat(begin, have) + B.ranges(have)

    # Initial buckets: the first q bytes.
    at = places(q)
    pointer = np.zeros(len(data), dtype=np.int64)
    alone = np.ones(len(data), dtype=bool)
    pointer[at], alone[at] = _buckets(B.RollingHash(data).grams(q)[at].view(np.int64))
    depth, fresh = q, len(data)
    for upto in (2 * q, 4 * q, length):
        at = places(upto)
        at = at[~alone[at]]
        # Sort each bucket by the bucket pointers at a later offset.
        new, single = _buckets(pointer[at] * (2 * fresh + 1) + pointer[at + upto - depth], fresh)
        nxt = pointer.copy()
        nxt[at], alone[at] = new, single
        pointer, depth, fresh = nxt, upto, fresh + len(data)
    return ~alone[places(length)]


def _buckets(key: np.ndarray, start: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Bucket number of every key (in key order, from ``start``), and whether it is alone."""
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    lead = np.concatenate([[True], ranked[1:] != ranked[:-1]]) if len(key) else np.empty(0, bool)
    group = np.cumsum(lead) - 1
    size = np.diff(np.append(np.flatnonzero(lead), len(key)))
    number, alone = np.empty(len(key), np.int64), np.empty(len(key), bool)
    number[order] = group + start
    alone[order] = size[group] == 1 if len(key) else alone
    return number, alone


def _runs(row: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
    """Rows (row, lo, n) of consecutive flagged strings, sorted by (row, place)."""
    new = np.concatenate([[True], (row[1:] != row[:-1]) | (place[1:] != place[:-1] + 1)]) if len(row) else np.empty(0, bool)
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(row)))
    return pa.RecordBatch.from_arrays(
        [pa.array(row[first]), pa.array(place[first].astype(np.int32)), pa.array(size.astype(np.int32))],
        names=["row", "lo", "n"])


def _load(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """(row, lo, n, single) and the bytes of a batch of segments."""
    row, lo, n, single = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3, 4))
    data = np.frombuffer(b"".join(batch.column(5).to_pylist()), dtype=np.uint8)
    return row, lo.astype(np.int64), n.astype(np.int64), single.astype(bool), data


def _refine_buckets(length: int):
    def flush(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        row, lo, n, single, data = (np.concatenate(x) for x in zip(*map(_load, held), strict=True))
        size = n + length - 1
        begin = np.cumsum(size) - size
        twice = refine(data, begin, n, length) & np.repeat(single, n)
        return _runs(np.repeat(row, n)[twice], (np.repeat(lo, n) + B.ranges(n))[twice])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Segments come sorted by anchor; whole anchor buckets are refined."""
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.nbytes
            if size < REFINE_BYTES:
                continue
            anchor = batch.column(0).to_numpy()
            cut = int(np.searchsorted(anchor, anchor[-1], side="left"))
            if cut:
                yield flush([*held[:-1], batch.slice(0, cut)])
                held, size = [batch.slice(cut)], int(batch.nbytes * (1 - cut / batch.num_rows))
        if held:
            yield flush(held)
    return run


def _halves(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Strings of large anchor buckets: identifiers of their two halves."""
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                row, lo, n, single, data = _load(whole.slice(at, 256))
                size = n + length - 1
                place = np.repeat(np.cumsum(size) - size, n) + B.ranges(n)
                grams = B.RollingHash(data).grams(length // 2).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grams[place]), pa.array(grams[place + length - length // 2]), pa.array(np.repeat(row, n)),
                     pa.array((np.repeat(lo, n) + B.ranges(n)).astype(np.int32)), pa.array(np.repeat(single, n))],
                    names=["head", "tail", "row", "lo", "single"])
    return run


def _removed(n_bytes: int, lo: np.ndarray, n: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of removed bytes, as starts and ends."""
    order = np.argsort(lo, kind="stable")
    start, end = lo[order], (lo + n + length - 1)[order]
    end = np.maximum.accumulate(end)
    lead = np.concatenate([[True], start[1:] > end[:-1]]) if len(start) else np.empty(0, bool)
    first = np.flatnonzero(lead)
    return start[first], end[np.append(first[1:], len(start)) - 1] if len(first) else end


def _result(text: bytes, lo: np.ndarray, n: np.ndarray, length: int, want_text: bool) -> tuple:
    starts, ends = _removed(len(text), lo, n, length)
    kept, last = [], 0
    for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
        kept.append(text[last:a])
        last = b
    rest = b"".join([*kept, text[last:]])
    return (len(text), len(text) - len(rest), len(starts), hashlib.sha256(rest).hexdigest(), rest if want_text else None)


RESULT = (("n_bytes", LongType()), ("n_removed", LongType()), ("n_spans", LongType()), ("kept_sha256", StringType()),
          ("kept", BinaryType()))
_RESULT_ARROW = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
_MORE = "array<struct<lo:int,n:int,anchor:bigint,single:boolean,large:boolean>>"


def _settle(length: int, want_text: bool, names: list[str]):
    settled_type = pa.list_(pa.struct([("lo", pa.int32()), ("n", pa.int32())]))
    open_type = pa.list_(pa.struct([("anchor", pa.int64()), ("lo", pa.int32()), ("n", pa.int32()), ("single", pa.bool_()),
                                    ("large", pa.bool_()), ("data", pa.binary())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Finish texts whose strings are all settled; hand on the others with their open segments."""
        for rows, buf, offsets in B.slices(batches, "__text"):
            width = rows.num_columns - 3  # keep columns, then __row, __text, __info
            infos = rows.column(width + 2).to_pylist()
            results, texts, settled, opens = [], [], [], []
            for i, info in enumerate(infos):
                text = buf[offsets[i]: offsets[i + 1]].tobytes()
                done = [x for x in info or [] if x["anchor"] is None]
                todo = [x for x in info or [] if x["anchor"] is not None]
                if todo:
                    results.append((None,) * 5)
                    texts.append(text)
                    settled.append([{"lo": x["lo"], "n": x["n"]} for x in done])
                    opens.append([{**x, "data": text[x["lo"]: x["lo"] + x["n"] + length - 1]} for x in todo])
                else:
                    lo = np.array([x["lo"] for x in done], dtype=np.int64)
                    n = np.array([x["n"] for x in done], dtype=np.int64)
                    results.append(_result(text, lo, n, length, want_text))
                    texts.append(None)
                    settled.append(None)
                    opens.append(None)
            cols = [pa.array([r[k] for r in results], t) for k, t in enumerate(_RESULT_ARROW)]
            yield pa.RecordBatch.from_arrays(
                [*rows.columns[: width + 1], *cols, pa.array(texts, pa.binary()), pa.array(settled, settled_type),
                 pa.array(opens, open_type)], names=names)
    return run


def _finish(length: int, want_text: bool, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                rows = batch.slice(at, 64)
                width = rows.num_columns - 3
                results = []
                for text, own, more in zip(*(rows.column(width + k).to_pylist() for k in range(3)), strict=True):
                    spans = [*own, *(more or [])]
                    lo = np.array([x["lo"] for x in spans], dtype=np.int64)
                    n = np.array([x["n"] for x in spans], dtype=np.int64)
                    results.append(_result(text, lo, n, length, want_text))
                cols = [pa.array([r[k] for r in results], t) for k, t in enumerate(_RESULT_ARROW)]
                yield pa.RecordBatch.from_arrays([*rows.columns[:width], *cols], names=names)
    return run


def remove_repeats(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), length: int = LENGTH,
                   want_text: bool = False, bucket_classes: int = BUCKET_CLASSES) -> DataFrame:
    """``keep`` columns plus n_bytes, n_removed, n_spans, kept_sha256, kept.

    ``kept`` (the remaining bytes) is filled where ``want_text`` is set.  A
    column of ``keep`` that is named like a result gives way to the result.
    """
    if length % 8:
        raise ValueError("length must be a multiple of 8")
    keep = tuple(k for k in keep if k.lower() not in {c for c, _ in RESULT})
    spark = docs.sparkSession
    store.prepare(spark)
    parts = store.fan_out(spark)
    keyed = store.with_row_key(docs.select(*keep, F.col(text).alias("__text")), "__row")
    # 1. Segments, and those that share their anchor with another.
    rows = keyed.select("__row", "__text").mapInArrow(
        _segment_rows(length), "row long, lo int, n int, anchor long, body long")
    rows = store.materialise(rows)
    # (Counts are written before they are joined back: a join that shares its
    # stage with the count could not be split at a hot anchor.)
    met = store.materialise(rows.groupBy("anchor").count().filter("count > 1").select("anchor"))
    shared = store.materialise(rows.join(met, "anchor", "left_semi"))
    # 2. Classes of equal segments; buckets that still have something to sort.
    classes = store.materialise(
        shared.groupBy("anchor", "body", "n").agg(F.count("*").alias("members"), F.min(F.struct("row", "lo")).alias("rep")))
    buckets = classes.groupBy("anchor").agg(F.count("*").alias("classes"), F.max(F.col("members") == 1).alias("some"))
    buckets = store.materialise(
        buckets.filter("classes > 1 AND some").select("anchor", (F.col("classes") > bucket_classes).alias("large")))
    info = F.struct("lo", "n", "anchor", "single", "large")
    todo = classes.join(buckets, "anchor").select(
        F.col("rep.row").alias("__row"), F.col("rep.lo").alias("lo"), "n", "anchor", (F.col("members") == 1).alias("single"), "large")
    repeated = classes.filter("members > 1").select("anchor", "body", "n")
    done = shared.join(repeated, ["anchor", "body", "n"], "left_semi").select(
        F.col("row").alias("__row"), "lo", "n", F.lit(None).cast("long").alias("anchor"),
        F.lit(None).cast("boolean").alias("single"), F.lit(None).cast("boolean").alias("large"))
    per = todo.union(done).groupBy("__row").agg(F.collect_list(info).alias("__info"))
    # The texts meet what is known of them; most are finished here.
    src = keyed.select(*keep, "__row", "__text").join(per, "__row", "left").select(*keep, "__row", "__text", "__info")
    base = [src.schema[c] for c in keep]
    out = StructType([*base, StructField("__row", LongType()), *(StructField(c, t) for c, t in RESULT),
                      StructField("__text", BinaryType())])
    seen = spark.createDataFrame([], "s array<struct<lo:int,n:int>>, o array<struct<anchor:bigint,lo:int,n:int,"
                                     "single:boolean,large:boolean,data:binary>>").schema
    out = StructType([*out.fields, StructField("__settled", seen["s"].dataType), StructField("__open", seen["o"].dataType)])
    state = store.materialise(src.mapInArrow(_settle(length, want_text, out.names), out))
    # 3. Refinement of the open segments.
    waiting = state.filter(F.col("__text").isNotNull())
    seg = waiting.select("__row", F.explode("__open").alias("s")).select(
        "s.anchor", F.col("__row").alias("row"), "s.lo", "s.n", "s.single", "s.data", "s.large")
    small = seg.filter("NOT large").drop("large").repartition(parts, "anchor").sortWithinPartitions("anchor")
    flagged = small.mapInArrow(_refine_buckets(length), "row long, lo int, n int")
    large = seg.filter("large").drop("large").mapInArrow(
        _halves(length), "head long, tail long, row long, lo int, single boolean")
    twice = store.materialise(large.groupBy("head", "tail").count().filter("count > 1").select("head", "tail"))
    flagged = flagged.union(large.filter("single").join(twice, ["head", "tail"], "left_semi")
                            .select("row", "lo", F.lit(1).alias("n")))
    more = flagged.groupBy(F.col("row").alias("__row")).agg(F.collect_list(F.struct("lo", "n")).alias("__more"))
    end = StructType([*base, *(StructField(c, t) for c, t in RESULT)])
    rest = (waiting.select(*keep, "__row", "__text", "__settled").join(more, "__row", "left")
            .select(*keep, "__text", "__settled", "__more").mapInArrow(_finish(length, want_text, end.names), end))
    return state.filter(F.col("__text").isNull()).select(*end.names).union(rest)

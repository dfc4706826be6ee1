"""SimHash near-duplicates by multi-index hashing.

1. ``fingerprints``: one 64-bit SimHash per text, from the XXH64 of its word
   shingles.
2. ``links``: a fingerprint is cut into three segments.  Two fingerprints at
   most 4 bits apart differ by at most (1, 1, 0) bits in some segment (two
   segments with 2 or more and one with 1 or more would already be 5), so a
   table per segment value is probed with the small Hamming ball of that
   radius, and matches are verified on all 64 bits.
3. ``connected``: components of the verified links, by alternating star
   contractions.

Groups: equal texts are one fingerprint before any table is built.  A table
bucket emits a spanning forest of its verified links, not its pairs.  A bucket
with more than ``BUCKET_ROWS`` entries is not compared pairwise: its members
meet at common midpoints instead (see ``_midpoints``), which is linear in its
members and finds the same components.

Defined cases: a null or word-less text has fingerprint zero and is linked
like any other; a text with fewer words than the shingle length is one
shingle; rows with null or repeated doc_id each get a result row; a component
whose rows all have null doc_id has a null component_id; empty tables give
empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm import blocks as B
from shelfline.llm import store

SEED = 42  # of XXH64
#: (first bit, width, radius) of the segments, for distances of at most 4.
SEGMENTS = ((0, 22, 1), (22, 21, 1), (43, 21, 0))
MAX_BITS = 4
#: Entries of one table bucket that are compared pairwise.
BUCKET_ROWS = 8192
PAIRS_AT_ONCE = 1 << 21


def simhash_block(buf: np.ndarray, offsets: np.ndarray, shingle: int) -> np.ndarray:
    """SimHash of every text of a block, as uint64."""
    n = len(offsets) - 1
    starts, ends, doc = B.word_spans(buf, offsets, B.NOT_WHITE)
    out = np.zeros(n, dtype=np.uint64)
    if not len(starts):
        return out
    # The words of the block, single-spaced: a shingle is a slice of this.
    lens = ends - starts
    flat = np.full(int(lens.sum()) + len(lens), 0x20, dtype=np.uint8)
    at = np.cumsum(lens + 1) - (lens + 1)
    flat[np.repeat(at, lens) + B.ranges(lens)] = B.LOWER[buf[np.repeat(starts, lens) + B.ranges(lens)]]
    words = np.bincount(doc, minlength=n)
    per = np.where(words >= shingle, words - shingle + 1, (words > 0).astype(np.int64))
    first = np.repeat(np.cumsum(words) - words, per) + B.ranges(per)
    last = first + np.minimum(np.repeat(words, per), shingle) - 1
    data, digest = flat.tobytes(), xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(data[a:b], SEED) for a, b in zip(at[first].tolist(), (at + lens)[last].tolist(), strict=True)),
        dtype=np.uint64, count=len(first))
    has = np.flatnonzero(per)
    begin = (np.cumsum(per) - per)[has]
    for bit in range(64):
        votes = np.add.reduceat(((hashes >> np.uint64(bit)) & np.uint64(1)).astype(np.int64), begin)
        out[has] |= (2 * votes > per[has]).astype(np.uint64) << np.uint64(bit)
    return out


def fingerprints(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
                 shingle: int = 4, name: str = "fingerprint") -> DataFrame:
    """``keep`` columns plus the SimHash (as a signed long with the same bits)."""
    store.prepare(docs.sparkSession)
    src = docs.select(*(F.col(c) for c in keep), F.col(text).alias("__text"))
    schema = src.drop("__text").withColumn(name, F.lit(0).cast("long")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, offsets in B.slices(batches, "__text"):
            fp = simhash_block(buf, offsets, shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [rows.column(i) for i in range(len(keep))] + [pa.array(fp)], names=[*keep, name])

    return src.mapInArrow(run, schema)


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Table entries of each fingerprint: itself and its probes per segment.

    A pair one bit apart in a segment has one side with a 0 there, so only
    flips of 0 to 1 need probing.
    """
    for batch in batches:
        fp = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        for seg, (low, width, radius) in enumerate(SEGMENTS):
            tag = np.uint64(seg) << np.uint64(60)
            value = (fp >> np.uint64(low)) & np.uint64((1 << width) - 1)
            yield _entry(tag | value, fp, 0)
            for bit in range(width if radius else 0):
                zero = (value >> np.uint64(bit)) & np.uint64(1) == 0
                yield _entry(tag | value[zero] | np.uint64(1 << bit), fp[zero], 1)


def _entry(key: np.ndarray, fp: np.ndarray, probe: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(key.view(np.int64)), pa.array(np.ascontiguousarray(fp).view(np.int64)),
         pa.array(np.full(len(fp), probe, np.int8))], names=["bucket", "fp", "probe"])


def _edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (node, smallest node of its component) of some edges."""
    if not len(a):
        return a, b
    nodes, inv = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = inv[: len(a)], inv[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        while True:  # pointer jumping
            jump = new[new]
            if np.array_equal(jump, new):
                break
            new = jump
        if np.array_equal(new, label):
            break
        label = new
    child = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[child], nodes[label[child]]


def _match_runs(bucket: np.ndarray, fp: np.ndarray, probe: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Verified links of whole buckets, reduced to a forest."""
    order = np.lexsort((probe, bucket))
    bucket, fp, probe = bucket[order], fp[order], probe[order]
    begin = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    size = np.diff(np.append(begin, len(bucket)))
    tables = np.add.reduceat((probe == 0).astype(np.int64), begin)
    at = B.ranges(size)
    base, own = np.repeat(begin, size), np.repeat(tables, size)
    # An entry of the table meets the later entries, a probe meets them all.
    first = np.where(probe == 0, at + 1, 0)
    count = np.maximum(own - first, 0)
    a = b = np.empty(0, np.uint64)
    done, upto = 0, np.cumsum(count)
    while done < len(count):
        stop = int(np.searchsorted(upto, (upto[done - 1] if done else 0) + PAIRS_AT_ONCE, side="right"))
        stop = max(stop, done + 1)
        c = count[done:stop]
        left = np.repeat(np.arange(done, stop), c)
        right = (base + first)[left] + B.ranges(c)
        near = np.bitwise_count(fp[left] ^ fp[right]) <= max_bits
        a, b = forest(np.concatenate([a, fp[left[near]]]), np.concatenate([b, fp[right[near]]]))
        done = stop
    return a, b


def _match(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by bucket; whole buckets are matched together."""
        held: list[tuple[np.ndarray, ...]] = []
        rows = 0
        for batch in batches:
            cols = tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            if not len(cols[0]):
                continue
            held.append(cols)
            rows += len(cols[0])
            if rows < 1 << 18:
                continue
            bucket, fp, probe = (np.concatenate(x) for x in zip(*held, strict=True))
            cut = int(np.searchsorted(bucket, bucket[-1], side="left"))
            if cut:
                yield _edges(*_match_runs(bucket[:cut], fp[:cut].view(np.uint64), probe[:cut], max_bits))
            held, rows = [(bucket[cut:], fp[cut:], probe[cut:])], len(bucket) - cut
        if rows:
            bucket, fp, probe = (np.concatenate(x) for x in zip(*held, strict=True))
            yield _edges(*_match_runs(bucket, fp.view(np.uint64), probe, max_bits))
    return run


def _midpoints(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Entries of large buckets, spread over midpoints.

        Two values at most 4 bits apart have a value within 2 bits of both,
        and two values within 2 bits of one are at most 4 apart.  A table
        entry goes to every value within 2 bits of it outside the segment; a
        probe, already one bit off, to those within 1.  All that meet are
        linked, so one link to the first is enough, and few can meet.
        """
        up = max_bits // 2
        for batch in batches:
            key, fp, probe = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            for seg, (low, width, _) in enumerate(SEGMENTS):
                mine = (key.view(np.uint64) >> np.uint64(60)) == seg
                inside = np.uint64(((1 << width) - 1) << low)
                bits = [np.uint64(1 << i) for i in range(64) if not low <= i < low + width]
                for role in (0, 1):
                    take = mine & (probe == role)
                    k, f = key[take], fp[take].view(np.uint64)
                    if not len(f):
                        continue
                    rest = f & ~inside
                    radius = up - role
                    yield _meet(k, rest, f)
                    for i, x in enumerate(bits if radius >= 1 else []):
                        yield _meet(k, rest ^ x, f)
                        for y in bits[i + 1:] if radius >= 2 else []:
                            yield _meet(k, rest ^ x ^ y, f)
    return run


def _meet(key: np.ndarray, mid: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(key), pa.array(mid.view(np.int64)), pa.array(np.ascontiguousarray(fp).view(np.int64))],
        names=["bucket", "mid", "fp"])


def _stars(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by (bucket, midpoint): link each to the first."""
        last = None
        for batch in batches:
            key, mid, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            if not len(key):
                continue
            new = np.concatenate([[True], (key[1:] != key[:-1]) | (mid[1:] != mid[:-1])])
            if last is not None and (key[0], mid[0]) == last[:2]:
                new[0] = False
            lead = np.maximum.accumulate(np.where(new, np.arange(len(key)), -1))
            head = np.where(lead >= 0, fp[np.maximum(lead, 0)], last[2] if last else 0)
            last = (key[-1], mid[-1], head[-1])
            a, b = fp.view(np.uint64), head.view(np.uint64)
            apart = a != b
            near = apart & (np.bitwise_count(a ^ b) <= max_bits)
            yield _edges(*forest(a[near], b[near]))
    return run


def links(distinct: DataFrame, max_bits: int = MAX_BITS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links (a, b) that connect what is linked at ``max_bits`` or fewer bits.

    ``distinct`` has one long column of distinct fingerprints.  The result is
    a spanning subset per bucket: components are those of all links.
    """
    if max_bits > MAX_BITS:
        raise ValueError(f"the segments are cut for at most {MAX_BITS} bits")
    if max_bits % 2:  # two values an odd number of bits apart have no midpoint within half of it
        raise ValueError("large buckets are linked through midpoints, which needs an even number of bits")
    spark = distinct.sparkSession
    store.prepare(spark)
    entries = distinct.toDF("fp").mapInArrow(_tables, "bucket long, fp long, probe byte")
    hot = store.materialise(entries.groupBy("bucket").count().filter(F.col("count") > bucket_rows).select("bucket"))
    cold = entries
    parts = store.fan_out(spark)
    if hot.head(1):
        cold = entries.join(hot, "bucket", "left_anti")
    found = (cold.repartition(parts, "bucket").sortWithinPartitions("bucket")
             .mapInArrow(_match(max_bits), "a long, b long"))
    if hot.head(1):
        met = entries.join(hot, "bucket", "left_semi").mapInArrow(_midpoints(max_bits), "bucket long, mid long, fp long")
        found = found.union(met.repartition(parts, "bucket", "mid").sortWithinPartitions("bucket", "mid", "fp")
                            .mapInArrow(_stars(max_bits), "a long, b long"))
    return found


def connected(edges: DataFrame) -> DataFrame:
    """Components of undirected edges (a, b): (node, root), root the smallest.

    Large-star and small-star steps in turn, until no edge changes.  Each step
    is a grouped minimum (partial before its shuffle), written, and a join
    that Spark can split at a hot node.
    """
    cur = store.materialise(edges.filter("a <> b").selectExpr("greatest(a, b) AS a", "least(a, b) AS b").distinct())
    state = None
    while True:
        both = cur.union(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = store.materialise(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        large = (both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .filter("a <> b").distinct())
        large = store.materialise(large)
        low = store.materialise(large.groupBy("a").agg(F.min("b").alias("m")))
        small = large.join(low, "a").selectExpr("stack(2, a, m, b, m) AS (a, b)").filter("a <> b").distinct()
        cur = store.materialise(small)
        now = tuple(cur.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
        if now == state:
            return cur.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now


def components(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", keep: tuple[str, ...] = (),
               shingle: int = 4, max_bits: int = MAX_BITS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per document: doc_id, ``keep``, fingerprint (long), component_id, root.

    ``root`` names the component also where component_id is null (it is the
    component's smallest fingerprint).  A column of ``keep`` that is named like
    a result gives way to the result.
    """
    names = (doc_id, *(k for k in keep if k.lower() not in (doc_id.lower(), "fingerprint", "component_id", "root")))
    fps = store.materialise(fingerprints(docs, text, names, shingle, "__fp"))
    per_fp = fps.groupBy("__fp").agg(F.min(doc_id).alias("__low"))
    roots = connected(links(per_fp.select("__fp"), max_bits, bucket_rows)).toDF("__fp", "__root")
    per_fp = per_fp.join(roots, "__fp", "left").withColumn("__root", F.coalesce("__root", "__fp"))
    best = store.materialise(per_fp.groupBy("__root").agg(F.min("__low").alias("component_id")))
    label = per_fp.select("__fp", "__root").join(best, "__root")
    return fps.join(label, "__fp").select(*names, F.col("__fp").alias("fingerprint"), "component_id",
                                          F.col("__root").alias("root"))


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 4,
             max_bits: int = MAX_BITS) -> DataFrame:
    """The documents, one of each component: the row with the smallest doc_id.

    Rows with a null doc_id stay only where their component has no other; of
    rows that repeat a doc_id (or have none) the first in the scan stays.
    """
    docs = store.clear(docs)
    keyed = store.with_row_key(docs, "__row")
    groups = components(keyed, text, doc_id, ("__row",), shingle, max_bits)
    first = F.struct(F.col(doc_id).isNull(), F.col(doc_id), F.col("__row"))
    chosen = groups.groupBy("root").agg(F.min_by("__row", first).alias("__row"))
    return keyed.join(chosen.select("__row"), "__row", "left_semi").select(*docs.columns)

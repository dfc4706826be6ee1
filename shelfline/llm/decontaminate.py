"""Benchmark decontamination by winnowing.

Words are runs of digits, letters a-z (A-Z lower-cased) and non-ASCII
characters.  A benchmark item has a window for every ``WINDOW`` consecutive
words; a shorter item is one window of all its words.  The fingerprint of a
text keeps, of every ``WINDOW - GRAM + 1`` consecutive word k-grams, the one
with the smallest hash.  A shared span of ``WINDOW`` words holds one such
group of k-grams, so both sides keep the same k-gram of it: joining the
fingerprints misses no shared window.  Hits are extended by comparing the
windows around them, and every word inside a shared window is hit.  Items
with fewer words than a window are fingerprinted whole.

Two ways to join, same results: up to ``MAX_BROADCAST`` benchmark windows
(counted first) every task holds the sorted fingerprints and windows, and the
documents are not shuffled; beyond that, document fingerprints are joined to
benchmark fingerprints by a shuffle, and so are the windows around hits.

Defined cases: a null or empty text has no words; an item without words has
no window; items that repeat an item_id or a text all count (an item_id once);
a null item_id is never reported but its words still hit; documents with null
or repeated doc_id each get a row; empty tables give empty or all-clean results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructField, StructType

from shelfline.llm import blocks as B
from shelfline.llm import store

WINDOW = 10
GRAM = 5
#: Benchmark windows that a task holds (under 50 bytes each with their
#: fingerprints, so at most 50 MB).
MAX_BROADCAST = 1_000_000


def word_hashes(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every word."""
    low = B.LOWER[buf]
    starts, ends, doc = B.word_spans(low, offsets, B.ALNUM_OR_HIGH)
    return B.RollingHash(low).spans(starts, ends), doc


def _inside(doc: np.ndarray, k: int) -> np.ndarray:
    """Starts of the runs of ``k`` words that stay in one text."""
    n = len(doc) - k + 1
    return np.flatnonzero(doc[:n] == doc[k - 1:]) if n > 0 else np.empty(0, np.int64)


def winnow(words: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(k-gram start, k-gram hash) kept for texts of ``WINDOW`` words or more."""
    starts = _inside(doc, WINDOW)
    if not len(starts):
        return starts, np.empty(0, np.uint64)
    grams = B.shingles(words, GRAM)
    least = B.window_min(grams, WINDOW - GRAM + 1)[starts]
    # Every k-gram equal to the minimum of a window it stands in is kept:
    # ties need no rule, and both sides keep the same hashes.
    kept = np.zeros(len(grams), dtype=bool)
    for j in range(WINDOW - GRAM + 1):
        at = starts + j
        kept[at] |= grams[at] == least
    at = np.flatnonzero(kept)
    return at, grams[at]


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of benchmark items: (item_id, words, window hash, fingerprints)."""
    for rows, buf, offsets in B.slices(batches, "__text"):
        words, doc = word_hashes(buf, offsets)
        counts = np.bincount(doc, minlength=rows.num_rows)
        starts = _inside(doc, WINDOW)
        hashes = B.shingles(words, WINDOW)[starts] if len(starts) else np.empty(0, np.uint64)
        kept_at, kept = winnow(words, doc)
        first = np.searchsorted(kept_at, starts)
        last = np.searchsorted(kept_at, starts + WINDOW - GRAM, side="right")
        item, size, window = list(doc[starts]), [WINDOW] * len(starts), list(hashes)
        prints = [kept[a:b].view(np.int64).tolist() for a, b in zip(first, last, strict=True)]
        begin = np.cumsum(counts) - counts
        for i in np.flatnonzero((counts > 0) & (counts < WINDOW)):
            n = int(counts[i])
            h = B.shingles(words[begin[i]: begin[i] + n], n)[0]
            item.append(i)
            size.append(n)
            window.append(h)
            prints.append([int(np.uint64(h).view(np.int64))])
        yield pa.RecordBatch.from_arrays(
            [rows.column(0).take(pa.array(item, pa.int64())), pa.array(size, pa.int32()),
             pa.array(np.array(window, dtype=np.uint64).view(np.int64)), pa.array(prints, pa.list_(pa.int64()))],
            names=["item", "size", "window", "prints"])


def benchmark_windows(benchmark: DataFrame, text: str = "text", item_id: str = "item_id") -> DataFrame:
    """Distinct (item, words in the window, window hash, its fingerprints)."""
    store.prepare(benchmark.sparkSession)
    src = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("__text"))
    return src.mapInArrow(_item_windows, "item string, size int, window long, prints array<long>").distinct()


class _Index:
    """Sorted fingerprints and windows of the benchmark, by window length."""

    def __init__(self, windows: pa.Table):
        """``windows`` as ``benchmark_windows`` has them; an item is its number in ``items``."""
        item = windows["item"].combine_chunks().dictionary_encode()
        self.items = item.dictionary.to_pylist()
        number = item.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int32)
        size, hashes = windows["size"].to_numpy(), windows["window"].to_numpy().view(np.uint64)
        prints = windows["prints"].combine_chunks()
        sizes = np.repeat(size, prints.value_lengths().to_numpy(zero_copy_only=False))
        flat = prints.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        self.prints, self.windows = {}, {}
        for n in np.unique(size).tolist():
            h, own = hashes[size == n], number[size == n]
            order = np.lexsort((own, h))
            self.windows[n] = (h[order], own[order])
            self.prints[n] = np.unique(flat[sizes == n])

    def hits(self, words: np.ndarray, doc: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length, window starts, window hashes) of windows around fingerprint hits."""
        for n, prints in self.prints.items():
            if n == WINDOW:
                at, grams = winnow(words, doc)
                at = at[_member(prints, grams)]
                # Extend: every window that holds the k-gram and stays in its text.
                near = np.unique((at[:, None] - np.arange(WINDOW - GRAM + 1)).ravel())
                near = near[(near >= 0) & (near + WINDOW <= len(doc))]
                near = near[doc[near] == doc[near + WINDOW - 1]]
            else:
                near = _inside(doc, n)
            if len(near):
                h = B.shingles(words, n)[near]
                ok = _member(self.windows[n][0], h)
                yield n, near[ok], h[ok]


def _member(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(values), dtype=bool)
    return table[np.minimum(np.searchsorted(table, values), len(table) - 1)] == values


RESULT = (("n_words", LongType()), ("n_hit", LongType()), ("items", ArrayType(StringType())),
          ("contaminated", BooleanType()))


def _result_schema(docs: DataFrame, prefix: str) -> StructType:
    return StructType(docs.schema.fields + [StructField(prefix + n, t) for n, t in RESULT])


def _attach(rows: pa.RecordBatch, names: list[str], n_words: np.ndarray, n_hit: np.ndarray, items: list) -> pa.RecordBatch:
    cols = [pa.array(n_words.astype(np.int64)), pa.array(n_hit.astype(np.int64)),
            pa.array(items, pa.list_(pa.string())), pa.array(n_hit > 0)]
    return pa.RecordBatch.from_arrays([*rows.columns, *cols], names=names)


def _covered(n_words: int, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    mark = np.zeros(n_words + 1, dtype=np.int64)
    np.add.at(mark, starts, 1)
    np.add.at(mark, starts + sizes, -1)
    return np.cumsum(mark[:-1]) > 0


def scan(docs: DataFrame, benchmark: DataFrame, text: str = "text", bench_text: str = "text",
         item_id: str = "item_id", prefix: str = "", max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """The documents plus n_words, n_hit, items (sorted item_ids as strings), contaminated.

    Input columns with these names are replaced.
    """
    spark = docs.sparkSession
    store.prepare(spark)
    docs = store.clear(docs, *(prefix + n for n, _ in RESULT))
    windows = store.materialise(benchmark_windows(benchmark, bench_text, item_id))
    if windows.count() > max_broadcast:
        return _scan_by_shuffle(docs, windows, text, prefix)
    shared = spark.sparkContext.broadcast(_Index(windows.toArrow()))
    schema = _result_schema(docs, prefix)
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for rows, buf, offsets in B.slices(batches, text):
            words, doc = word_hashes(buf, offsets)
            n = rows.num_rows
            at, size, found = [], [], [set() for _ in range(n)]
            for length, starts, hashes in index.hits(words, doc):
                at.append(starts)
                size.append(np.full(len(starts), length))
                table, own = index.windows[length]
                lo, hi = np.searchsorted(table, hashes), np.searchsorted(table, hashes, side="right")
                pairs = np.unique(np.stack([np.repeat(doc[starts], hi - lo),
                                            own[np.repeat(lo, hi - lo) + B.ranges(hi - lo)]]), axis=1)
                for d, i in pairs.T[pairs[1] >= 0].tolist():
                    found[d].add(index.items[i])
            hit = _covered(len(words), np.concatenate(at), np.concatenate(size)) if at else np.zeros(len(words), bool)
            yield _attach(rows, names, np.bincount(doc, minlength=n), np.bincount(doc[hit], minlength=n),
                          [sorted(x) for x in found])

    return docs.mapInArrow(run, schema)


def _print_rows(lengths: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Fingerprints of documents with the windows around them."""
        for rows, buf, offsets in B.slices(batches, "__text"):
            words, doc = word_hashes(buf, offsets)
            begin = np.searchsorted(doc, np.arange(len(offsets)))
            for n in lengths:
                if n == WINDOW:
                    at, grams = winnow(words, doc)
                    near = at[:, None] - np.arange(WINDOW - GRAM + 1)
                    ok = (near >= 0) & (near + WINDOW <= len(doc))
                    ok &= doc[np.where(ok, near, 0)] == doc[np.where(ok, near + WINDOW - 1, 0)]
                    ok &= doc[np.where(ok, near, 0)] == doc[at][:, None] if len(at) else ok
                    at, grams = np.repeat(at, ok.sum(axis=1)), np.repeat(grams, ok.sum(axis=1))
                    start = near[ok]
                else:
                    start = at = _inside(doc, n)
                    grams = B.shingles(words, n)[start] if len(start) else np.empty(0, np.uint64)
                if not len(start):
                    continue
                window = B.shingles(words, n)[start]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0).take(pa.array(doc[start])), pa.array((start - begin[doc[start]]).astype(np.int64)),
                     pa.array(np.full(len(start), n, np.int32)), pa.array(grams.view(np.int64)),
                     pa.array(window.view(np.int64))], names=["row", "start", "size", "print", "window"])
    return run


def _scan_by_shuffle(docs: DataFrame, windows: DataFrame, text: str, prefix: str) -> DataFrame:
    """``scan`` for a benchmark too large to hold: joins by fingerprint, then window."""
    keyed = store.with_row_key(docs, "__row")
    lengths = sorted(r[0] for r in windows.select("size").distinct().collect())  # at most WINDOW values
    src = keyed.select(F.col("__row").alias("row"), F.col(text).alias("__text"))
    mine = src.mapInArrow(_print_rows(lengths), "row long, start long, size int, print long, window long")
    prints = store.materialise(windows.select("size", F.explode("prints").alias("print")).distinct())
    near = mine.join(prints, ["size", "print"], "left_semi").select("row", "start", "size", "window").distinct()
    hits = near.join(windows.select("size", "window", "item").distinct(), ["size", "window"])
    # Per document: distinct windows and items, summed up before the shuffle.
    per = hits.groupBy("row").agg(F.collect_set(F.struct("start", "size")).alias("__spans"),
                                  F.collect_set("item").alias("__items"))
    joined = keyed.join(per.withColumnRenamed("row", "__row"), "__row", "left").drop("__row")
    schema = _result_schema(docs, prefix)
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, offsets in B.slices(batches, text):
            _, doc = word_hashes(buf, offsets)
            n_words = np.bincount(doc, minlength=rows.num_rows)
            n_hit, items = np.zeros(rows.num_rows, np.int64), []
            spans = rows.column(rows.num_columns - 2).to_pylist()
            for i, (s, found) in enumerate(zip(spans, rows.column(rows.num_columns - 1).to_pylist(), strict=True)):
                items.append(sorted(found or []))
                if s:
                    a, b = np.array([(x["start"], x["size"]) for x in s]).T
                    n_hit[i] = _covered(int(n_words[i]), a, b).sum()
            yield _attach(rows.select(list(range(rows.num_columns - 2))), names, n_words, n_hit, items)

    return joined.mapInArrow(run, schema)


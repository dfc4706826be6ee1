r"""Phrase collocations per language by SON partitioning.

Phrases are 2 to 4 consecutive words of a piece; ASCII capitals count as small
letters, pieces end at ``[.,;:!?\x0A-\x0D]``, words are ``[^\x20\x09]+``.

1. Local mining.  The tasks of a scan are dealt into ``shards``; every phrase
   occurrence lies in one shard, so a phrase found ``support`` times has
   support / shards or more in some shard.  Each shard is mined completely at
   that lower support (as 64-bit hashes, summed up per task before they are
   shuffled by shard and phrase), for 1 word, then 2, 3 and 4: a phrase is
   counted only if both its parts of one word less are locally frequent in some
   shard, as they are wherever the phrase is.  A shard is many tasks, so mining
   one is a job of any size, and the local support stays the same however much
   data there is.
2. Union.  Locally frequent phrases of all shards go into one bitmap of fixed
   size (2^``BITMAP_BITS`` bits).  It has all candidates; other phrases pass
   only where they share a bit, which costs work and changes no result.
3. Global counts.  A last scan counts every phrase that passes, by its text,
   and the number of words.  Sums of ``support`` or more are exact: no phrase with
   so many occurrences is missed by step 1, and all its occurrences pass.
4. Scores: see ``score``.

Within a block of texts (about 1 MB) equal phrases are told by a 64-bit hash,
between blocks by their text.

Defined cases: null and empty texts have no words; a null language is a
language of its own in ``collocations`` unless the caller replaces it; rows
that repeat a text count again; other columns don't matter; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm import blocks as B
from shelfline.llm import store

LONGEST = 4
SUPPORT = 30
SHARDS = 3
TOP = 2000
CONTAINED = 80
SCALE = 2_000_000
BITMAP_BITS = 26
_BLOCK = 1 << 20
_HELD = 1 << 20
_ARROW = 1 << 16
_SALTS = 64

_BREAK = B.byte_table(b".,;:!?" + bytes(range(0x0A, 0x0E)))
_WORD = ~(_BREAK | B.byte_table(b" \t"))


class _Block:
    """Words of a block of texts, laid out with one space after each word."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray):
        # A line end between texts: no piece runs on into the next text.
        raw = B.LOWER[np.insert(buf, offsets[1:], 0x0A)]
        ends_of_texts = offsets + np.arange(len(offsets))
        inside = _WORD[raw]
        before = np.concatenate([[False], inside[:-1]])
        starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(~inside & before)
        kept = inside | before
        self.line = raw[kept]
        self.line[~inside[kept]] = 0x20
        place = np.cumsum(kept) - 1
        self.start, self.end = place[starts], place[ends]
        self.doc = B.owners(ends_of_texts, starts)
        breaks = np.cumsum(_BREAK[raw])[starts]
        self._joined = breaks[1:] == breaks[:-1]
        self._hash = B.RollingHash(self.line)

    def phrases(self, n: int) -> np.ndarray:
        """First words of all phrases of ``n`` words."""
        last = len(self.start) - n + 1
        if last <= 0:
            return np.empty(0, np.int64)
        ok = np.ones(last, dtype=bool)
        for k in range(n - 1):
            ok &= self._joined[k: k + last]
        return np.flatnonzero(ok)

    def keys(self, at: np.ndarray, n: int, language: np.ndarray) -> np.ndarray:
        """Hash of (language, phrase) for phrases of ``n`` words at ``at``."""
        return B.mix(self._hash.spans(self.start[at], self.end[at + n - 1]) ^ language[self.doc[at]])

    def texts(self, at: np.ndarray, n: int) -> pa.Array:
        """The phrases' words, joined by single spaces."""
        start = self.start[at]
        size = self.end[at + n - 1] - start
        data = self.line[np.repeat(start, size) + B.ranges(size)]
        offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
        return pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(data))


def _languages(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Per row its language's hash and number, and the languages."""
    coded = rows.column(rows.schema.get_field_index("lang")).dictionary_encode("encode")
    names = coded.dictionary
    data = [b"\0" if x is None else b"\1" + x.encode() for x in names.to_pylist()]
    sizes = np.array([len(x) for x in data], dtype=np.int64)
    ends = np.cumsum(sizes)
    hashes = B.RollingHash(np.frombuffer(b"".join(data), dtype=np.uint8)).spans(ends - sizes, ends)
    number = coded.indices.to_numpy(zero_copy_only=False)
    return hashes[number], number, names


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, where each is first met, and how often."""
    order = np.argsort(keys)
    ranked = keys[order]
    lead = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(keys) else np.empty(0, np.int64)
    return ranked[lead], order[lead], np.diff(np.append(lead, len(keys)))


def _merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sums of (key, count) arrays by key."""
    keys, counts = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.argsort(keys)
    ranked = keys[order]
    lead = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(keys) else np.empty(0, np.int64)
    return ranked[lead], np.add.reduceat(counts[order], lead) if len(lead) else counts


def _mine(n: int, shards: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(shard, phrase hash, occurrences) of this task's phrases of ``n`` words whose parts pass."""
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId() % shards

        def rows(keys, counts):
            for i in range(0, len(keys), _ARROW):
                key, count = keys[i: i + _ARROW], counts[i: i + _ARROW]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(key), shard, np.int32)), pa.array(key.view(np.int64)), pa.array(count.astype(np.int64))],
                    names=["shard", "key", "count"])

        held, size = [], 0
        for batch, buf, offsets in B.slices(batches, "text", _BLOCK):
            language, _, _ = _languages(batch)
            block = _Block(buf, offsets)
            at = block.phrases(n)
            if shared is not None:
                at = at[_passes(shared.value, block.keys(at, n - 1, language))]
                at = at[_passes(shared.value, block.keys(at + 1, n - 1, language))]
            held.append(np.unique(block.keys(at, n, language), return_counts=True))
            size += len(held[-1][0])
            if size >= _HELD:
                held = [_merged(held)]
                size = len(held[0][0])
                if size >= _HELD // 2:
                    yield from rows(*held[0])
                    held, size = [], 0
        if held:
            yield from rows(*_merged(held))
    return run


def _bitmap(keys: DataFrame, bits: int) -> np.ndarray:
    """Union of keys as a bitmap (64 bits a row on the way: at most 2^(bits - 6) rows)."""
    word = F.shiftrightunsigned("key", 6).bitwiseAND(F.lit((1 << (bits - 6)) - 1)).alias("word")
    bit = F.expr("shiftleft(1L, CAST(key & 63 AS INT))")
    found = keys.groupBy(word).agg(F.bit_or(bit).alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), dtype=np.uint64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return out


def _passes(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    word = (keys >> np.uint64(6)) & np.uint64(len(bitmap) - 1)
    return (bitmap[word.astype(np.int64)] >> (keys & np.uint64(63))) & np.uint64(1) == 1


def _count(longest: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(lang, words, phrase, occurrences) per block; zero words: all word occurrences."""
        for rows, buf, offsets in B.slices(batches, "text", _BLOCK):
            language, number, names = _languages(rows)
            block = _Block(buf, offsets)

            def made(lang, n, phrase, count, names=names):
                return pa.RecordBatch.from_arrays(
                    [pc.take(names, pa.array(lang)).cast(pa.string()), pa.array(np.full(len(count), n, np.int32)), phrase,
                     pa.array(count.astype(np.int64))], names=["lang", "words", "phrase", "count"])

            total = np.bincount(number[block.doc], minlength=len(names))
            yield made(np.arange(len(names)), 0, pa.array([""] * len(names), pa.string()), total)
            for n in range(1, longest + 1):
                at = block.phrases(n)
                keys = block.keys(at, n, language)
                ok = _passes(shared.value, keys)
                at, keys = at[ok], keys[ok]
                _, first, count = _distinct(keys)
                for i in range(0, len(first), _ARROW):
                    some = at[first[i: i + _ARROW]]
                    yield made(number[block.doc[some]], n, block.texts(some, n), count[i: i + _ARROW])
    return run


def frequent(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, support: int = SUPPORT,
             shards: int = SHARDS, bitmap_bits: int = BITMAP_BITS) -> DataFrame:
    """(lang, words, phrase, a): phrases of one and more words with ``support`` occurrences or more, exactly counted.

    A row of zero words per language has the number of its word occurrences.
    """
    spark = docs.sparkSession
    store.prepare(spark)
    src = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    found, shared = np.zeros(1 << (bitmap_bits - 6), dtype=np.uint64), None
    for n in range(1, longest + 1):
        local = src.mapInArrow(_mine(n, shards, shared), "shard int, key long, count long").groupBy("shard", "key").agg(
            F.sum("count").alias("count")).filter(F.col("count") >= -(-support // shards))
        found |= _bitmap(local.select("key"), bitmap_bits)
        shared = spark.sparkContext.broadcast(found)
    parts = src.mapInArrow(_count(longest, shared), "lang string, words int, phrase string, count long")
    total = parts.groupBy("lang", "words", "phrase").agg(F.sum("count").alias("a"))
    return store.materialise(total.filter((F.col("words") == 0) | (F.col("a") >= support)))


def _wide(c: Column) -> Column:
    return c.cast("decimal(20,0)")


def _same(a: str, b: str) -> Column:
    return F.col(f"{a}.lang").eqNullSafe(F.col(f"{b}.lang"))


def score(counts: DataFrame, contained: int = CONTAINED, scale: int = SCALE) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the phrases that no longer candidate contains.

    A cut after k words gives l and r, the counts of both parts, and
    floor(scale * a / (l + r)); the least score counts, then the smallest k.
    A candidate inside a longer one with contained % or more of its count goes.
    """
    cands = counts.filter("words > 1").withColumn("part", F.split("phrase", " "))

    def some(start: Column, n: Column) -> Column:
        return F.array_join(F.slice("part", start, n), " ")

    cuts = cands.select("lang", "words", "phrase", "a", "part", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", some(F.lit(1), F.col("k")).alias("head"),
                       some(F.col("k") + 1, F.col("words") - F.col("k")).alias("tail"))
    known = counts.filter("words > 0").select("lang", F.col("phrase").alias("known"), "a")
    both = (cuts.alias("c").join(known.alias("h"), _same("c", "h") & (F.col("c.head") == F.col("h.known")))
            .select("c.*", F.col("h.a").alias("l")).alias("c")
            .join(known.alias("t"), _same("c", "t") & (F.col("c.tail") == F.col("t.known")))
            .select("c.*", F.col("t.a").alias("r")))
    value = F.expr(f"CAST({scale} AS DECIMAL(10,0)) * CAST(a AS DECIMAL(20,0)) DIV (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))")
    best = both.groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), F.min(F.struct(value.alias("score"), "k", "l", "r")).alias("cut"))
    # Every contiguous shorter phrase of two or more words, with the largest count of a candidate around it.
    inner = cands.filter("words > 2").select(
        "lang", "words", "a", "part", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("n"))
    inner = inner.select("lang", "a", "part", "n", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("n") + 1)).alias("at"))
    around = inner.select("lang", some(F.col("at"), F.col("n")).alias("phrase"), "a").groupBy("lang", "phrase").agg(
        F.max("a").alias("most"))
    joined = best.alias("b").join(around.alias("o"), _same("b", "o") & (F.col("b.phrase") == F.col("o.phrase")), "left")
    gone = _wide(F.col("o.most")) * F.lit(100) >= _wide(F.col("b.a")) * F.lit(contained)
    return joined.filter(F.col("o.most").isNull() | ~gone).select(
        "b.lang", "b.phrase", "b.a", F.col("b.cut.l").alias("l"), F.col("b.cut.r").alias("r"), F.col("b.cut.score").alias("score"))


def best_per_language(scored: DataFrame, top: int = TOP) -> DataFrame:
    """The first ``top`` of each language with their rank; a large language is thinned in salted parts first."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(_SALTS))
    few = scored.withColumn("__salt", salt).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "__salt").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.filter(F.col("rank") <= top).drop("__salt")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, support: int = SUPPORT,
                 shards: int = SHARDS, contained: int = CONTAINED, top: int = TOP, bitmap_bits: int = BITMAP_BITS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases, best first."""
    counts = frequent(docs, text, lang, longest, support, shards, bitmap_bits)
    words = counts.filter("words = 0").select("lang", F.col("a").alias("n"))
    best = best_per_language(score(counts, contained), top)
    return best.alias("b").join(words.alias("w"), _same("b", "w")).select(
        "b.lang", "b.rank", "b.phrase", "b.a", "b.l", "b.r", "w.n", "b.score")

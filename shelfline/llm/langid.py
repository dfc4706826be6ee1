"""Language identification with bit-sliced Bloom filters of n-grams.

A language is learnt from a sample of its labelled texts: different texts in the
order of their hashes, until they have ``TRAIN_CHARS`` characters; texts longer
than that do not train.  Every byte n-gram (``GRAM`` bytes of the lower-cased
text, runs of non-letters as one space) of the sample is kept, so the filter is
bounded by the sample and nothing is dropped by its frequency.  All languages
share one filter: place ``i`` of the filter holds a bitmask with a bit per
language, so one lookup of ``HASHES`` places, and-ed, tells all languages that
hold an n-gram.

A text's score for a language is the count of its n-grams in the filter
(a popcount of the language's bit slice), corrected for the filter's false
positives: with rate f, n lookups and c hits, (c - f n) / (1 - f).

Defined cases: a text that is null or has no letters is ``und`` with score 0;
a text whose n-grams are all unknown gets the most frequent language, score 0;
ties go to the more frequent language (characters of all its training rows,
repeats included), then the smaller name; rows without language or text do not
train; without training rows every text is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from shelfline.llm import blocks as B
from shelfline.llm import store

GRAM = 5
HASHES = 4
TRAIN_CHARS = 1_000_000  # characters of the training sample, per language
BITS_PER_GRAM = 12
MAX_LANGUAGES = 64
UND = "und"
_HELD = 1 << 20  # distinct n-grams that a training task sums up before it writes them out

_LETTER_BYTE = B.byte_table([*range(0x61, 0x7B), *range(0x80, 0x100)])
_LETTER = regex.compile(r"\p{L}")


def grams(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams packed into integers, text number): spaces around words, none across texts."""
    low = B.LOWER[buf]
    starts, ends, doc = B.word_spans(low, offsets, _LETTER_BYTE)
    lens = ends - starts
    n = len(offsets) - 1
    # Each text becomes " word word ... word "; texts with no word are empty.
    words = np.bincount(doc, minlength=n)
    at = np.cumsum(lens + 1) - lens + np.cumsum(words > 0)[doc] - 1 if len(lens) else lens
    total = int(lens.sum() + len(lens) + (words > 0).sum())
    flat = np.full(total, 0x20, dtype=np.uint8)
    flat[np.repeat(at, lens) + B.ranges(lens)] = low[np.repeat(starts, lens) + B.ranges(lens)]
    size = np.bincount(doc, weights=lens + 1, minlength=n).astype(np.int64) + (words > 0)
    owner = np.repeat(np.arange(n), size)
    m = total - GRAM + 1
    if m <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    packed = np.zeros(m, dtype=np.int64)
    for j in range(GRAM):
        packed = packed << 8 | flat[j: j + m]
    ok = owner[:m] == owner[GRAM - 1:]
    return packed[ok], owner[:m][ok]


def _seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: distinct (lang, n-gram), merged up to a bound before they are written."""
    held: dict[str, list[np.ndarray]] = {}
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, parts in held.items():
            own = np.unique(np.concatenate(parts))
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(own), pa.string()), pa.array(own)], names=["lang", "gram"])
        held.clear()

    for rows, buf, offsets in B.slices(batches, "__text"):
        langs = np.array(rows.column(0).to_pylist(), dtype=object)
        packed, owner = grams(buf, offsets)
        for lang in sorted(set(langs)):
            own = np.unique(packed[(langs == lang)[owner]])
            if len(own):
                held.setdefault(lang, []).append(own)
                size += len(own)
        if size > _HELD:
            for lang in held:
                held[lang] = [np.unique(np.concatenate(held[lang]))]
            size = sum(len(p[0]) for p in held.values())
            if size > _HELD // 2:
                yield from flush()
                size = 0
    yield from flush()


@dataclass(frozen=True)
class Filters:
    """The bit-sliced filter and what corrects its counts."""

    languages: list[str]     # by frequency, then name; bit i is language i
    masks: np.ndarray        # one bitmask per place
    false_rate: np.ndarray   # per language

    def lookup(self, packed: np.ndarray) -> np.ndarray:
        """Bitmask of the languages that hold each n-gram."""
        found = np.full(len(packed), np.iinfo(np.uint64).max, dtype=np.uint64)
        for place in places(packed, len(self.masks)):
            found &= self.masks[place]
        return found


def places(packed: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """The filter places of each n-gram (``size`` is a power of two)."""
    h = B.mix(packed.view(np.uint64))
    step = B.mix(h) | np.uint64(1)
    for i in range(HASHES):
        yield ((h + step * np.uint64(i)) & np.uint64(size - 1)).astype(np.int64)


def _up_to(ends: dict[str, int]) -> Column:
    """Whether a row's hash is at most its language's bound."""
    parts = [(F.col("lang") == name) & (F.col("hash") <= F.lit(end)) for name, end in sorted(ends.items())]
    return reduce(or_, parts, F.lit(False))


def train(rows: DataFrame, text: str = "text", lang: str = "lang", train_chars: int = TRAIN_CHARS) -> Filters:
    """Filters from a sample of the rows with a language (see above).

    The sample is a range of text hashes per language, so the driver gets one
    bound per language, and the n-grams of at most ``train_chars`` characters
    (and the text that passes them) per language.
    """
    spark = rows.sparkSession
    store.prepare(spark)
    src = rows.filter(F.col(lang).isNotNull() & (F.col(text) != "")).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("__text"),
        F.xxhash64(text).alias("hash"), F.length(text).cast("long").alias("size"))
    texts = store.materialise(src.groupBy("lang", "hash").agg(F.max("size").alias("size"), F.count("*").alias("n")))
    fits = F.when(F.col("size") <= train_chars, F.col("size"))
    totals = (texts.groupBy("lang").agg(F.sum(F.col("size") * F.col("n")).alias("total"), F.sum(fits).alias("fits"))
              .orderBy(F.desc("total"), "lang").limit(MAX_LANGUAGES + 1).collect())
    if len(totals) > MAX_LANGUAGES:
        raise ValueError(f"a filter place has {MAX_LANGUAGES} bits, one per language")
    languages = [r.lang for r in totals]
    # Hashes below this bound hold about twice the sample; it ends where the characters before reach theirs.
    below = {r.lang: int(min(2 * train_chars / r.fits, 1) * (2 ** 64 - 1)) - 2 ** 63 for r in totals if r.fits}
    before = F.sum("size").over(Window.partitionBy("lang").orderBy("hash").rowsBetween(Window.unboundedPreceding, -1))
    ends = (texts.filter(_up_to(below)).filter(F.col("size") <= train_chars).withColumn("before", F.coalesce(before, F.lit(0)))
            .filter(F.col("before") < train_chars).groupBy("lang").agg(F.max("hash").alias("end")).collect())
    sample = src.filter(_up_to({r.lang: r.end for r in ends})).filter(F.col("size") <= train_chars)
    found = store.materialise(sample.select("lang", "__text").mapInArrow(_seen, "lang string, gram long").distinct())
    kept = [found.filter(F.col("lang") == name).select("gram").toArrow()["gram"].to_numpy() for name in languages]
    most = max((len(k) for k in kept), default=1)
    size = 1 << max(10, int(np.ceil(np.log2(max(most, 1) * BITS_PER_GRAM))))
    masks = np.zeros(size, dtype=np.uint64)
    for bit, own in enumerate(kept):
        for place in places(own, size):
            masks[np.unique(place)] |= np.uint64(1 << bit)
    fill = np.array([np.mean(masks >> np.uint64(b) & np.uint64(1)) for b in range(len(kept))])
    return Filters(languages, masks, fill ** HASHES)


def predict_block(filters: Filters, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(language number or -1, score) per text."""
    n = len(offsets) - 1
    packed, owner = grams(buf, offsets)
    k = len(filters.languages)
    if not k:
        return np.full(n, -1), np.zeros(n)
    looked = np.bincount(owner, minlength=n)
    found = filters.lookup(packed)
    hits = np.stack([np.bincount(owner[(found >> np.uint64(b) & np.uint64(1)) == 1], minlength=n) for b in range(k)], axis=1)
    true = np.maximum((hits - filters.false_rate * looked[:, None]) / (1 - np.minimum(filters.false_rate, 0.999)), 0)
    best = true.argmax(axis=1)
    share = true[np.arange(n), best] / np.maximum(looked, 1)
    return best, np.clip(share, 0.0, 1.0)


def predict(docs: DataFrame, filters: Filters, text: str = "text", prefix: str = "") -> DataFrame:
    """The documents plus lang_pred and score (input columns of these names are replaced)."""
    spark = docs.sparkSession
    store.prepare(spark)
    docs = store.clear(docs, prefix + "lang_pred", prefix + "score")
    shared = spark.sparkContext.broadcast(filters)
    schema = StructType([*docs.schema.fields, StructField(prefix + "lang_pred", StringType()),
                         StructField(prefix + "score", DoubleType())])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        labels = np.array([*model.languages, UND], dtype=object)
        for rows, buf, offsets in B.slices(batches, text):
            best, score = predict_block(model, buf, offsets)
            col = rows.column(rows.schema.get_field_index(text)).to_pylist()
            real = np.array([bool(t and _LETTER.search(t)) for t in col], dtype=bool)
            best, score = np.where(real, best, -1), np.where(real, score, 0.0)
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(labels[best].tolist(), pa.string()), pa.array(score)],
                                             names=names)

    return docs.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """Rows kept from training: crc32 of the id as text, modulo 4, is 2 (null: not)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))

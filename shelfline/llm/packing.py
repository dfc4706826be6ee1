"""Packing into fixed-size sequences: first-fit decreasing in random groups.

1. Every text becomes token ids and an end id.  Ids beyond a whole number of
   sequences are the document's rest; whole sequences need no packing.
2. Rests are dealt at random (by a hash of their row) into groups of about
   ``group_docs``.  A group is packed by itself: rests in order of decreasing
   length, each into the first bin with room, found in a tournament tree whose
   inner nodes hold the largest free capacity below them.
3. What first-fit leaves open is closed by cutting: the emptiest bins of a
   group fill the gaps of the fullest, which leaves at most one open bin.  That
   one is cut at powers of two, where sequences need no padding.

A task holds one block of texts, or one group (at most a few thousand rests of
less than a sequence).

Texts are encoded word by word (between ASCII white space), with the distinct
words a worker has met remembered up to ``CACHE_BYTES``: right for tokenizers that
fold capitals, drop white space and never join words or a letter with a mark,
which ``word_bpe_49k.json`` does.  A block's words are looked up once each, and
new words of letters are encoded many at a time, told apart by the tokens that
end a word.

Defined cases: null and empty texts have the end id alone; rows that repeat a
text or a key, or have a null key, are documents of their own; kept columns
named like a result column give way to it; an empty table gives no rows.
"""

from __future__ import annotations

import os
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from shelfline.llm import blocks as B
from shelfline.llm import store

SIZE = 2048
GROUP_DOCS = 2048
END_ID = 1
CACHE_BYTES = 128 << 20
_BLOCK_BYTES = 4 << 20
_STEP_WORDS = 1 << 19
_LINE_WORDS = 256
_SEED = 2048
_MARKS = "!\"#$%&()*+,-./:;<=>?@[]^_`{|}~"

RESULT = (("start", LongType()), ("length", LongType()), ("ids", BinaryType()), ("doc_tokens", LongType()),
          ("sequence_id", LongType()), ("offset", LongType()))


class WordEncoder:
    """Ids of whole texts (little-endian uint32), each distinct word encoded once."""

    # Workers of both byte orders would need a swap here.
    assert sys.byteorder == "little" and array("I").itemsize == 4

    def __init__(self, spec: str, special_as_text: bool = True):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_str(spec)
        self._tokenizer.encode_special_tokens = special_as_text
        self._fold = special_as_text  # else a folded text might spell a special token
        self._ends = _word_ends(self._tokenizer)
        self._known: dict[str, bytes] = {}
        self._held = 0

    def encode(self, text: bytes) -> bytes:
        return self.encode_all(pa.array([text.decode()]))[0].tobytes()

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of some texts (strings, null is empty) one after another, and where each text's ids begin and end."""
        texts = texts.fill_null("")
        # ASCII capitals are folded here, as the tokenizer folds all capitals.
        split = pc.ascii_split_whitespace(pc.ascii_lower(texts) if self._fold else texts)
        words = split.flatten()  # some are empty, beside white space at an end
        ids, sizes = [np.empty(0, "<u4")], [np.zeros(1, np.int64)]
        for at in range(0, len(words), _STEP_WORDS):
            part = self._part(words.slice(at, _STEP_WORDS).dictionary_encode())
            places = np.frombuffer(part.buffers()[1], np.int64)[part.offset: part.offset + len(part) + 1]
            ids.append(np.frombuffer(part.buffers()[2] or b"", np.uint8)[places[0]: places[-1]].view("<u4"))
            sizes.append(np.diff(places) // 4)
        ends = np.cumsum(np.concatenate(sizes))
        return np.concatenate(ids), ends[np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy())])]

    def _part(self, words: pa.DictionaryArray) -> pa.LargeBinaryArray:
        distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = list(map(self._known.get, distinct))
        if None in ids:
            if self._held > CACHE_BYTES:
                self._known, self._held = {}, 0
                ids = [None] * len(distinct)
            missing = [k for k, i in enumerate(ids) if i is None]
            for k, i in zip(missing, self._learn([distinct[k] for k in missing]), strict=True):
                ids[k] = i
        return pa.array(ids, pa.large_binary()).take(words.indices)

    def _learn(self, words: list[str]) -> Iterator[bytes]:
        marked = {w: p for w in words if w[-1:] in _MARKS and len(p := self._cut(w)) > 1}
        fresh = {w for w in words if w not in marked}
        fresh.update(x for p in marked.values() for x in p if x not in self._known)
        plain = [x for x in fresh if x.isalpha()] if self._ends is not None else []
        fresh.difference_update(self._learn_together(plain))
        self._learn_singly(list(fresh))
        for w, (core, marks) in marked.items():
            self._keep(w, self._known[core] + self._known[marks])
        return map(self._known.__getitem__, words)

    def _learn_singly(self, words: list[str]) -> None:
        for w, c in zip(words, self._tokenizer.encode_batch_fast(words, add_special_tokens=False), strict=True):
            self._keep(w, array("I", c.ids).tobytes())

    def _learn_together(self, words: list[str]) -> list[str]:
        """Words of letters, many to a line: each ends with the only token of it that ends a word.

        Returns the words learnt: a line with another number of such tokens
        (a letter that folds into a letter and a mark) is left out.
        """
        learnt = []
        lines = [words[i: i + _LINE_WORDS] for i in range(0, len(words), _LINE_WORDS)]
        coded = self._tokenizer.encode_batch_fast([" ".join(x) for x in lines], add_special_tokens=False)
        for line, c in zip(lines, coded, strict=True):
            raw = array("I", c.ids)
            ends = np.flatnonzero(self._ends[np.frombuffer(raw, "<u4")]) + 1
            if len(ends) == len(line) and ends[-1] == len(raw):
                at, ids = 0, raw.tobytes()
                for w, end in zip(line, (4 * ends).tolist(), strict=True):
                    self._keep(w, ids[at: end])
                    at = end
                learnt += line
        return learnt

    def _keep(self, word: str, ids: bytes) -> None:
        self._known[word] = ids
        self._held += len(word) + len(ids) + 170

    def _cut(self, word: str) -> tuple[str, ...]:
        """A word and the marks behind it, which are tokens of their own after a letter or digit."""
        core = word.rstrip(_MARKS)
        if not self._fold or len(core) == len(word) or not core:
            return (word,)
        # (A capital may fold into a letter and a combining mark, which joins the marks.)
        return (core, word[len(core):]) if core[-1].isalnum() and core[-1].lower()[-1].isalnum() else (word,)


def _word_ends(tokenizer) -> np.ndarray | None:
    """Flags of the ids that end a word; None where a tokenizer does not mark the end of every word."""
    from tokenizers.pre_tokenizers import ByteLevel

    suffix = getattr(tokenizer.model, "end_of_word_suffix", None)
    vocabulary = tokenizer.get_vocab(with_added_tokens=False)
    if not suffix or any(c + suffix not in vocabulary for c in ByteLevel.alphabet()):
        return None
    flags = np.zeros(tokenizer.get_vocab_size(with_added_tokens=True), dtype=bool)
    flags[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
    return flags


_ENCODERS: dict[tuple, WordEncoder] = {}


def worker_encoder(spec: str, special_as_text: bool) -> WordEncoder:
    """This worker's encoder: what a task has learnt serves the worker's next task."""
    key = (hash(spec), special_as_text)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = WordEncoder(spec, special_as_text)
    return _ENCODERS[key]


class Bins:
    """Open bins in a tournament tree: a node holds the largest free capacity below it."""

    def __init__(self, size: int, most: int):
        self._leaves = 1
        while self._leaves < most:
            self._leaves *= 2
        self._free = [size] * (2 * self._leaves)

    def first_fit(self, length: int) -> int:
        """Put ``length`` into the first bin with room; the bin's number."""
        free, node = self._free, 1
        while node < self._leaves:
            node *= 2
            if free[node] < length:  # no bin on the left has room
                node += 1
        bin_number = node - self._leaves
        free[node] -= length
        while node > 1:
            node //= 2
            free[node] = max(free[2 * node], free[2 * node + 1])
        return bin_number


def first_fit_decreasing(lengths: list[int], size: int) -> list[list[int]]:
    """Bins of item numbers; items in decreasing length, each into the first bin with room."""
    tree = Bins(size, len(lengths))
    bins: list[list[int]] = []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        at = tree.first_fit(lengths[i])
        if at == len(bins):
            bins.append([])
        bins[at].append(i)
    return bins


def close_gaps(bins: list[list[int]], lengths: list[int], size: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (item, start, length) that are all full or a power of two long."""
    filled = [[(i, 0, lengths[i]) for i in b] for b in bins]
    used = [sum(p[2] for p in b) for b in filled]
    order = sorted(range(len(bins)), key=lambda b: (-used[b], b))  # fullest first
    lo, hi = 0, len(order) - 1
    while lo < hi:
        gap = size - used[order[lo]]
        if gap == 0:
            lo += 1
            continue
        source = filled[order[hi]]
        if not source:
            hi -= 1
            continue
        item, start, length = source.pop()
        take = min(gap, length)
        filled[order[lo]].append((item, start + length - take, take))
        used[order[lo]] += take
        used[order[hi]] -= take
        if take < length:
            source.append((item, start, length - take))
    done = [filled[b] for b in order if used[b] == size]
    for b in order:
        if 0 < used[b] < size:
            done += _powers_of_two(filled[b], used[b])
    return done


def _powers_of_two(pieces: list[tuple[int, int, int]], total: int) -> Iterator[list[tuple[int, int, int]]]:
    """The pieces cut into sequences whose lengths are the powers of two of ``total``."""
    waiting = pieces[::-1]
    for bit in range(total.bit_length() - 1, -1, -1):
        if not total >> bit & 1:
            continue
        room, out = 1 << bit, []
        while room:
            item, start, length = waiting.pop()
            take = min(room, length)
            out.append((item, start, take))
            room -= take
            if take < length:
                waiting.append((item, start + take, length - take))
        yield out


def _pieces(shared, end_id: int, size: int, keep: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole sequences of every document, then its rest."""
        encoder = worker_encoder(*shared.value)
        for rows, _, _ in B.slices(batches, "__text", _BLOCK_BYTES):
            ids, places = encoder.encode_all(rows.column(keep).cast(pa.string()))
            total = np.diff(places) + 1  # with the end id
            flat = np.insert(ids, places[1:], end_id)
            pieces = -(-total // size)
            row = np.repeat(np.arange(len(total)), pieces)
            start = B.ranges(pieces) * size
            length = np.minimum(size, total[row] - start)
            cuts = np.concatenate([[0], np.cumsum(4 * length)])
            coded = pa.Array.from_buffers(pa.large_binary(), len(row), [None, pa.py_buffer(cuts), pa.py_buffer(flat)])
            mine = [rows.column(c).take(pa.array(row)) for c in range(keep)]
            yield pa.RecordBatch.from_arrays(
                [*mine, pa.array(start), pa.array(length.astype(np.int32)), coded.cast(pa.binary()), pa.array(total[row])], names=names)
    return run


def _pack_group(size: int, names: list[str]):
    def run(group: pa.Table) -> pa.Table:
        lengths = group["length"].to_pylist()
        starts, ids = group["start"].to_pylist(), group["ids"].to_pylist()
        base = group["__group"][0].as_py() << 32
        row, start, length, cut, sequence, offset = [], [], [], [], [], []
        for number, pieces in enumerate(close_gaps(first_fit_decreasing(lengths, size), lengths, size)):
            at = 0
            for item, first, n in pieces:
                row.append(item)
                start.append(starts[item] + first)
                length.append(n)
                cut.append(ids[item][4 * first: 4 * (first + n)])
                sequence.append(2 * (base | number))
                offset.append(at)
                at += n
        made = {"start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()), "ids": pa.array(cut, pa.binary()),
                "sequence_id": pa.array(sequence, pa.int64()), "offset": pa.array(offset, pa.int64())}
        taken = group.take(pa.array(row, pa.int64()))
        return pa.table({c: made[c] if c in made else taken[c] for c in names})
    return run


def pack(docs: DataFrame, spec: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), end_id: int = END_ID,
         size: int = SIZE, group_docs: int = GROUP_DOCS, special_as_text: bool = True) -> DataFrame:
    """One row per piece: ``keep`` columns, start, length, ids, doc_tokens, sequence_id, offset.

    ``spec`` is a tokenizer's JSON text (of bounded size, broadcast); ``size``
    a power of two.  ``ids`` are the piece's ids as little-endian unsigned
    32-bit numbers.  ``special_as_text`` reads the strings of special tokens as
    ordinary text.
    """
    if size < 2 or size & (size - 1):
        raise ValueError("size must be a power of two")
    spark = docs.sparkSession
    store.prepare(spark)
    made = [n for n, _ in RESULT]
    keep = tuple(c for c in keep if c.lower() not in made)
    src = docs.select(*keep, F.col(text).alias("__text"))
    schema = StructType([*(src.schema[c] for c in keep), StructField("start", LongType()), StructField("length", IntegerType()),
                         StructField("ids", BinaryType()), StructField("doc_tokens", LongType())])
    shared = spark.sparkContext.broadcast((spec, special_as_text))
    cut = store.with_row_key(src.mapInArrow(_pieces(shared, end_id, size, len(keep), schema.names), schema), "__piece")
    whole = cut.filter(F.col("length") == size).select(
        *keep, "start", F.col("length").cast("long").alias("length"), "ids", "doc_tokens",
        (F.col("__piece") * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rests = cut.filter(F.col("length") < size)
    groups = max(1, -(-rests.count() // group_docs))
    dealt = rests.withColumn("__group", F.pmod(F.xxhash64("__piece", F.lit(_SEED)), F.lit(groups)))
    out = StructType([*(src.schema[c] for c in keep), *(StructField(n, t) for n, t in RESULT)])
    packed = dealt.drop("__piece").groupBy("__group").applyInArrow(_pack_group(size, out.names), out)
    return whole.union(packed)

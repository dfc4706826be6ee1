"""Byte-level BPE encoding and decoding by corpus-level merge replay.

The distinct pre-tokens of a block of texts form the corpus.  An inverted
index maps each token pair (by its merge rank) to the word positions where it
stands; ranks are replayed in rising order, and a merge updates only the two
neighbours of its position.  Index entries wait in bins of consecutive ranks;
a bin is drained in passes that merge, in every word at once, the lowest-ranked
pair the word has.  Words do not touch each other, so this gives each word
its merges in rank order, as replaying the whole corpus rank by rank would.

A task replays its texts block by block and remembers words up to a bound, so
memory depends neither on the corpus nor on its vocabulary.

Defined cases: a null or empty text has no tokens; a text of one long word is
one word of the index; special tokens are ordinary text; ids that a vocabulary
lacks raise on decoding.
"""

from __future__ import annotations

import base64
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from shelfline.llm import blocks as B
from shelfline.llm import store

BIN = 64  # ranks per bin of the index
BLOCK_BYTES = 4 << 20
REMEMBER = 400_000  # words a task remembers between blocks
_NONE = np.iinfo(np.int32).max
# Unicode white space, as the rank files' splitter reads \s.
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_PLAIN_LIMIT = 0x250  # below: one table of letters and digits, so the faster matcher serves


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by id, from a rank file (base64 bytes and rank per line)."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    out: list[bytes] = [b""] * len(pairs)
    for token, rank in pairs:
        out[int(rank)] = base64.b64decode(token)
    return out


class Splitter:
    """Pre-tokens of a text by a pattern; plain Latin texts take a faster matcher."""

    def __init__(self, pattern: str):
        spaced = pattern.replace("\\S", f"[^{_SPACE}]")
        spaced = re.sub(r"\[\^([^\]]*)\\s([^\]]*)\]", lambda m: f"[^{m[1]}{_SPACE}{m[2]}]", spaced)
        spaced = spaced.replace("\\s", f"[{_SPACE}]")
        self._any = regex.compile(spaced)
        plain = spaced
        for prop in "LN":
            chars = "".join(re.escape(chr(c)) for c in range(_PLAIN_LIMIT) if unicodedata.category(chr(c))[0] == prop)
            plain = re.sub(r"\[\^([^\]]*)\\p\{%s\}([^\]]*)\]" % prop, lambda m, c=chars: f"[^{m[1]}{c}{m[2]}]", plain)
            plain = plain.replace("\\p{%s}" % prop, f"[{chars}]")
        self._plain = None if "\\p" in plain else re.compile(plain)
        self._beyond = re.compile(f"[^\\x00-{chr(_PLAIN_LIMIT - 1)}]")

    def __call__(self, text: str) -> list[str]:
        if self._plain is not None and not self._beyond.search(text):
            return self._plain.findall(text)
        return self._any.findall(text)


class MergeReplay:
    """Encodes distinct words by replaying merges over an index of their pairs."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.rank = {t: i for i, t in enumerate(tokens)}
        if any(bytes([b]) not in self.rank for b in range(256)):
            raise ValueError("the ranks lack single bytes")
        self._byte = np.array([self.rank[bytes([b])] for b in range(256)], dtype=np.int32)
        keys, ranks = [], []
        self._calm = np.ones(len(tokens), dtype=bool)
        get = self.rank.get
        for r, t in enumerate(tokens):
            for cut in range(1, len(t)):
                a, b = get(t[:cut]), get(t[cut:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    ranks.append(r)
                    # A merge to ``a`` or ``b`` can make a pair of lower rank.
                    self._calm[a] &= a < r
                    self._calm[b] &= b < r
        order = np.argsort(np.array(keys, dtype=np.int64))
        self._keys = np.array(keys, dtype=np.int64)[order]
        self._ranks = np.array(ranks, dtype=np.int32)[order]

    def _rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        if not len(self._keys):
            return np.full(len(a), _NONE, np.int32)
        key = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where(self._keys[at] == key, self._ranks[at], _NONE).astype(np.int32)

    def _until_lower(self, i: np.ndarray, sym: np.ndarray, pair: np.ndarray, before: np.ndarray,
                     after: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Of each word's merges, those up to the first that makes a pair of lower rank."""
        several = word[i[1:]] == word[i[:-1]]
        if not several.any():
            return i
        n, made, j = len(sym), pair[i], after[i]
        k, h = after[j], before[i]
        right = np.full(len(i), _NONE, np.int32)
        at = k < n
        right[at] = self._rank_of(made[at], sym[k[at]])
        # The left neighbour may have just been merged itself.
        new = np.concatenate([[False], several & (j[:-1] == h[1:])])
        beside = np.where(new, made, sym[np.minimum(h, n - 1)])
        left = np.full(len(i), _NONE, np.int32)
        at = h < n
        left[at] = self._rank_of(beside[at], made[at])
        lower = (np.minimum(right, left) < made).astype(np.int64)
        passed = np.cumsum(lower) - lower
        lead = np.concatenate([[True], ~several])
        return i[passed == np.maximum.accumulate(np.where(lead, passed, 0))]

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all words, concatenated, and the offsets of each word."""
        whole = [self.rank.get(w, -1) for w in words]
        # A word that is a token is that token, as the rank files' reader has it.
        todo = [i for i, r in enumerate(whole) if r < 0 and words[i]]
        flat, sizes = self._replay([words[i] for i in todo])
        count = np.array([1 if r >= 0 else 0 for r in whole], dtype=np.int64)
        count[todo] = sizes
        offsets = np.concatenate([[0], np.cumsum(count)])
        ids = np.empty(int(offsets[-1]), dtype=np.int32)
        known = np.array([i for i, r in enumerate(whole) if r >= 0], dtype=np.int64)
        ids[offsets[known]] = np.array(whole, dtype=np.int64)[known]
        ids[np.repeat(offsets[todo] if todo else [], sizes).astype(np.int64) + B.ranges(sizes)] = flat
        return ids, offsets

    def _replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if not words:
            return np.empty(0, np.int32), np.empty(0, np.int64)
        lens = np.array([len(w) for w in words], dtype=np.int64)
        sym = self._byte[np.frombuffer(b"".join(words), dtype=np.uint8)].copy()
        n = len(sym)
        word = np.repeat(np.arange(len(words), dtype=np.int32), lens)
        after = np.arange(1, n + 1, dtype=np.int64)
        after[np.cumsum(lens) - 1] = n          # no right neighbour
        before = np.arange(-1, n - 1, dtype=np.int64)
        before[np.cumsum(lens) - lens] = n      # no left neighbour
        pair = np.full(n + 1, _NONE, dtype=np.int32)  # rank of the pair that starts here
        left = np.flatnonzero(after < n)
        pair[left] = self._rank_of(sym[left], sym[left + 1])
        live = np.ones(n, dtype=bool)

        bins: dict[int, list[np.ndarray]] = {}

        def index(at: np.ndarray) -> int:
            """Enter positions under the bins of their pairs; the lowest bin."""
            at = at[pair[at] != _NONE]
            if not len(at):
                return 1 << 30
            which = pair[at] // BIN
            order = np.argsort(which, kind="stable")
            at, which = at[order], which[order]
            cut = np.flatnonzero(np.concatenate([[True], which[1:] != which[:-1]]))
            for a, b in zip(cut, np.append(cut[1:], len(at)), strict=True):
                bins.setdefault(int(which[a]), []).append(at[a:b])
            return int(which[0])

        index(left)
        while bins:
            this = min(bins)
            at = np.unique(np.concatenate(bins.pop(this)))
            while True:
                at = at[pair[at] // BIN == this]  # entries that still hold
                if not len(at):
                    break
                # The lowest-ranked pair of each word; positions are in word order.
                owner, rank = word[at], pair[at]
                first = np.concatenate([[True], owner[1:] != owner[:-1]])
                group = np.cumsum(first) - 1
                least = np.minimum.reduceat(rank, np.flatnonzero(first))
                i = at[rank == least[group]]
                # Equal pairs of a word merge from the left; of overlapping ones
                # (aaa) every other.
                joins = np.concatenate([[False], after[i[:-1]] == i[1:]])
                run = np.arange(len(i)) - np.maximum.accumulate(np.where(joins, 0, np.arange(len(i))))
                i = i[run % 2 == 0]
                if not self._calm[pair[i]].all():
                    i = self._until_lower(i, sym, pair, before, after, word)
                j = after[i]
                sym[i] = pair[i]
                live[j] = False
                pair[j] = _NONE
                k = after[j]
                after[i] = k
                has = k < n
                before[k[has]] = i[has]
                pair[i] = _NONE
                pair[i[has]] = self._rank_of(sym[i[has]], sym[k[has]])
                h = before[i]
                has = h < n
                pair[h[has]] = self._rank_of(sym[h[has]], sym[i[has]])
                touched = np.concatenate([i, h[has]])
                same = pair[touched] // BIN == this
                low = index(touched[~same])
                at = np.unique(np.concatenate([at, touched[same]]))
                if low < this:  # a merge made a pair of lower rank: go back to it
                    at = at[pair[at] // BIN == this]
                    if len(at):
                        bins.setdefault(this, []).append(at)
                    break
        return sym[live], np.bincount(word[live], minlength=len(words))


class TextEncoder:
    """Encodes texts; remembers words between calls."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self._replay, self._split = MergeReplay(tokens), Splitter(pattern)
        self._forget()

    def _forget(self) -> None:
        self._number: dict[str, int] = {}
        self._ids = np.empty(0, np.int32)
        self._offsets = np.zeros(1, np.int64)

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, concatenated, and the offsets of each text."""
        if len(self._number) > REMEMBER:
            self._forget()
        number, parts, sizes = self._number, [], []
        for t in texts:
            words = self._split(t) if t else []
            for w in words:
                if w not in number:
                    number[w] = len(number)
            parts.append(np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words)))
            sizes.append(len(words))
        fresh = list(number)[len(self._offsets) - 1:]
        if fresh:
            ids, offsets = self._replay.encode([w.encode("utf-8") for w in fresh])
            self._offsets = np.concatenate([self._offsets, offsets[1:] + self._offsets[-1]])
            self._ids = np.concatenate([self._ids, ids])
        which = np.concatenate(parts) if parts else np.empty(0, np.int64)
        length = self._offsets[which + 1] - self._offsets[which]
        ids = self._ids[np.repeat(self._offsets[which], length) + B.ranges(length)]
        ends = np.concatenate([[0], np.cumsum(length)])
        return ids, ends[np.concatenate([[0], np.cumsum(np.array(sizes, dtype=np.int64))])]


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", name: str = "ids") -> DataFrame:
    """The documents plus their token ids (array<int>).

    ``ranks_path`` is read on the driver; the ranks (a vocabulary file of
    bounded size) are sent to the tasks.
    """
    spark = docs.sparkSession
    store.prepare(spark)
    docs = store.clear(docs, name)
    shared = spark.sparkContext.broadcast(read_ranks(ranks_path))
    schema = StructType(docs.schema.fields + [StructField(name, ArrayType(IntegerType(), False))])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TextEncoder(shared.value, pattern)
        for rows, _, _ in B.slices(batches, text, BLOCK_BYTES):
            col = rows.column(rows.schema.get_field_index(text))
            ids, offsets = encoder(col.to_pylist())
            made = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
            yield pa.RecordBatch.from_arrays([*rows.columns, made], names=names)

    return docs.mapInArrow(run, schema)


def decode(rows: DataFrame, ranks_path: str, ids: str = "ids", name: str = "bytes") -> DataFrame:
    """The rows plus the bytes their token ids stand for (binary; null ids: empty)."""
    spark = rows.sparkSession
    store.prepare(spark)
    rows = store.clear(rows, name)
    shared = spark.sparkContext.broadcast(read_ranks(ranks_path))
    schema = StructType(rows.schema.fields + [StructField(name, BinaryType())])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = shared.value
        flat = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        size = np.array([len(t) for t in tokens], dtype=np.int64)
        begin = np.cumsum(size) - size
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                col = part.column(part.schema.get_field_index(ids))
                made = []
                for cell in col:
                    own = cell.values.to_numpy(zero_copy_only=False) if cell.is_valid else np.empty(0, np.int64)
                    if len(own) and (own.min() < 0 or own.max() >= len(tokens)):
                        raise ValueError("an id is not in the vocabulary")
                    length = size[own]
                    made.append(flat[np.repeat(begin[own], length) + B.ranges(length)].tobytes())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(made, pa.binary())], names=names)

    return rows.mapInArrow(run, schema)


def id_digest(ids: str) -> F.Column:
    """Hex SHA-256 of decimal ids joined by commas."""
    return F.sha2(F.concat_ws(",", F.col(ids).cast("array<string>")), 256)

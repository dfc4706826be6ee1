"""Arrow blocks of text inside Spark tasks: word spans, rolling hashes, slices.

The operators run as ``mapInArrow`` functions.  A task never holds more than
one block of texts (about ``BLOCK_BYTES``, or one text if it is longer) as
numpy arrays; Spark decides partitioning, shuffles and retries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
U64 = np.uint64

# Multiplier of the rolling polynomial (odd, so it has an inverse mod 2**64).
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
_LENGTH_MARK = 0xA24BAED4963EE407
_BYTE_CODES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)

_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """First ``n`` powers of the base and of its inverse (kept per worker)."""
    have = _POWERS.get("up")
    if have is None or len(have) < n:
        size = max(n, BLOCK_BYTES + 1)
        for name, b in (("up", _BASE), ("down", _BASE_INV)):
            steps = np.full(size, b, dtype=np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser: spreads every input bit over the word."""
    x = (x ^ (x >> U64(32))) * U64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U64(32))) * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


class RollingHash:
    """64-bit hashes of any byte ranges of one buffer, from one prefix sum."""

    def __init__(self, buf: np.ndarray):
        up, self._down = _powers(len(buf) + 1)
        self._prefix = np.empty(len(buf) + 1, dtype=np.uint64)
        self._prefix[0] = 0
        np.cumsum(_BYTE_CODES[buf] * up[: len(buf)], out=self._prefix[1:])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of every ``buf[start:end]``; equal bytes give equal hashes."""
        raw = (self._prefix[ends] - self._prefix[starts]) * self._down[starts]
        return mix(raw + (ends - starts).astype(np.uint64) * U64(_LENGTH_MARK))

    def grams(self, k: int) -> np.ndarray:
        """Hash of every ``buf[i:i+k]``."""
        n = len(self._prefix) - k
        if n <= 0:
            return np.empty(0, dtype=np.uint64)
        raw = (self._prefix[k:] - self._prefix[:n]) * self._down[:n]
        return mix(raw + U64(k * _LENGTH_MARK % (1 << 64)))


def slices(batches: Iterator[pa.RecordBatch], text: str,
           limit: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut record batches into blocks of about ``limit`` text bytes.

    Yields (rows, bytes, offsets): text ``i`` of the block is
    ``bytes[offsets[i]:offsets[i+1]]``; a null text is empty.
    """
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(text))
        if col.null_count:
            col = col.fill_null("")
        wide = pa.types.is_large_string(col.type)
        _, off_buf, data_buf = col.buffers()
        offs = np.frombuffer(off_buf, dtype=np.int64 if wide else np.int32)[col.offset: col.offset + len(col) + 1] \
            if off_buf is not None and len(col) else np.zeros(1, np.int64)
        offs = offs.astype(np.int64)
        data = np.frombuffer(data_buf, dtype=np.uint8) if data_buf is not None else np.empty(0, np.uint8)
        i, n = 0, len(col)
        while i < n:
            j = int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1
            j = min(max(j, i + 1), n)
            yield batch.slice(i, j - i), data[offs[i]: offs[j]], offs[i: j + 1] - offs[i]
            i = j


def byte_table(members: bytes | range, invert: bool = False) -> np.ndarray:
    """Boolean table over byte values."""
    t = np.zeros(256, dtype=bool)
    t[list(members)] = True
    return ~t if invert else t


WHITE = bytes([0x20, *range(0x09, 0x0E)])
NOT_WHITE = byte_table(WHITE, invert=True)
# Words of letters, digits and every non-ASCII character (after lower-casing A-Z).
ALNUM_OR_HIGH = byte_table([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def word_spans(buf: np.ndarray, offsets: np.ndarray,
               table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of table bytes per text: (starts, ends, text number)."""
    if not len(buf):
        e = np.empty(0, np.int64)
        return e, e, e
    inside = table[buf]
    edge = np.zeros(len(buf) + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty(len(buf), dtype=bool)
    before[0] = False
    before[1:] = inside[:-1]
    after = np.empty(len(buf), dtype=bool)
    after[-1] = False
    after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, owners(offsets, starts)


def owners(offsets: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """Text number of each byte position."""
    return np.searchsorted(offsets, positions, side="right") - 1


def shingles(word_hash: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive word hashes (across texts too)."""
    n = len(word_hash) - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    acc = np.zeros(n, dtype=np.uint64)
    mult = U64(1)
    with np.errstate(over="ignore"):
        for j in range(k):
            acc += word_hash[j: j + n] * mult
            mult = mult * U64(0xBF58476D1CE4E5B9) + U64(2)
    return mix(acc + U64(k))


def window_min(values: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every window of ``w`` values (two running minima per block)."""
    n = len(values) - w + 1
    if n <= 0:
        return values[:0]
    pad = (-len(values)) % w
    grid = np.concatenate([values, np.full(pad, np.iinfo(values.dtype).max, values.dtype)]).reshape(-1, w)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[w - 1: w - 1 + n])


def ranges(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for every count, concatenated."""
    total = int(counts.sum())
    ends = np.cumsum(counts)
    return np.arange(total) - np.repeat(ends - counts, counts)

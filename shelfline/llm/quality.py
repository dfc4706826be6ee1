"""Quality rules: base measures of a text, and a line labeller that decides.

A linear-chain conditional random field labels every line with words as
content or boilerplate; Viterbi decoding gives the labels, and the share of
words in content lines decides whether the text is kept.  The field is trained
on a bounded sample of labelled documents (``TRAIN_DOCS``), whose lines carry
their document's quality as the label.

Defined cases: a null or word-less text has zero measures and fails the base
rules; line features are computed over whole texts of any length; without
usable labels (empty table, one class only) the field falls back to fixed
weights that reject symbol, shouting and table lines.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from shelfline.llm import blocks as B
from shelfline.llm import store

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
REPEAT_WINDOW = 5
MIN_CONTENT_SHARE = 0.5
#: Bound of the training sample: labelled documents, and characters of each.
TRAIN_DOCS = 2000
TRAIN_CHARS = 50_000
SYMBOLS = b"#*$%&|<>"

FEATURES = ("bias", "symbol share", "mostly capitals", "exclamation share", "pipe words", "repeated line",
            "stuttered words")
CONTENT, BOILERPLATE = 0, 1


@dataclass(frozen=True)
class LineModel:
    """Weights of the field: label score = features @ unary, plus transitions."""

    unary: np.ndarray       # features x labels
    transition: np.ndarray  # label before x label

    @staticmethod
    def fallback() -> LineModel:
        """Used where nothing can be learned: junk marks count against a line."""
        w = np.zeros((len(FEATURES), 2))
        w[0] = (1.5, 0.0)
        w[[1, 3, 4, 6], BOILERPLATE] = 12.0
        w[2, BOILERPLATE] = 4.0
        return LineModel(w, np.array([[0.5, 0.0], [0.0, 0.5]]))


_SYMBOL = B.byte_table(SYMBOLS)
_UPPER = B.byte_table(range(0x41, 0x5B))
_LEAD = B.byte_table(range(0x80, 0xC0), invert=True)  # first bytes of code points
_NOT_LF = B.byte_table(b"\n", invert=True)


def _counter(flags: np.ndarray) -> np.ndarray:
    out = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=out[1:])
    return out


def _seen_before(group: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Whether an equal value stands earlier in the same group."""
    key = B.mix(value ^ B.mix(group.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key, kind="stable")
    again = np.zeros(len(key), dtype=bool)
    again[order[1:]] = key[order[1:]] == key[order[:-1]]
    return again


def _repeat_words(word_hash: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Words per text that stand in a window found twice or more in the text."""
    grams = B.shingles(word_hash, REPEAT_WINDOW)
    same = np.flatnonzero(doc[: len(grams)] == doc[REPEAT_WINDOW - 1:]) if len(grams) else np.empty(0, np.int64)
    key = B.mix(grams[same] ^ B.mix(doc[same].astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key)
    eq = key[order[1:]] == key[order[:-1]]
    twice = np.zeros(len(key), dtype=bool)
    twice[order[1:]] |= eq
    twice[order[:-1]] |= eq
    mark = np.zeros(len(word_hash) + 1, dtype=np.int64)
    at = same[twice]
    np.add.at(mark, at, 1)
    np.add.at(mark, at + REPEAT_WINDOW, -1)
    covered = np.cumsum(mark[:-1]) > 0
    return np.bincount(doc[covered], minlength=n)


def measure(buf: np.ndarray, offsets: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Base measures per text; line features, text and words of every line with words."""
    n = len(offsets) - 1
    starts, ends, doc = B.word_spans(buf, offsets, B.NOT_WHITE)
    rolling = B.RollingHash(buf)
    base = {"n_words": np.bincount(doc, minlength=n)}
    points = _counter(_LEAD[buf])
    chars = points[ends] - points[starts]
    base["word_chars"] = np.bincount(doc, weights=chars, minlength=n).astype(np.int64)
    symbol = _counter(_SYMBOL[buf])
    base["n_symbols"] = symbol[offsets[1:]] - symbol[offsets[:-1]]
    line_start, line_end, line_doc = B.word_spans(buf, offsets, _NOT_LF)
    first = np.searchsorted(starts, line_start)
    words = np.searchsorted(starts, line_end) - first
    full = words > 0
    line_start, line_end, line_doc, first, words = (x[full] for x in (line_start, line_end, line_doc, first, words))
    again = _seen_before(line_doc, rolling.spans(line_start, line_end))
    base["n_dup_lines"] = np.bincount(line_doc[again], minlength=n)
    word_hash = rolling.spans(starts, ends)
    base["n_repeat_words"] = _repeat_words(word_hash, doc, n)
    cum = np.concatenate([[0], np.cumsum(chars)])
    line_chars = np.maximum(cum[first + words] - cum[first], 1)
    share = lambda table: (lambda c: (c[line_end] - c[line_start]) / line_chars)(_counter(table[buf]))
    # Words equal to the word before; the first word of a line has none.
    echo = np.concatenate([[0, 0], np.cumsum(word_hash[1:] == word_hash[:-1])]) if len(starts) else np.zeros(1, np.int64)
    single = (ends - starts == 1) & (buf[starts] == 0x7C) if len(starts) else np.empty(0, bool)
    pipes = np.concatenate([[0], np.cumsum(single)])
    features = np.stack([
        np.ones(len(first)), share(_SYMBOL), (share(_UPPER) > 0.5).astype(float), share(B.byte_table(b"!")),
        (pipes[first + words] - pipes[first]) / np.maximum(words, 1), again.astype(float),
        (echo[first + words] - echo[first + 1]) / np.maximum(words, 1),
    ], axis=1) if len(first) else np.empty((0, len(FEATURES)))
    return base, features, line_doc, words


def _by_step(doc: np.ndarray) -> list[np.ndarray]:
    """Line numbers by their place in their text: step t has the t-th lines."""
    begin = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else np.empty(0, np.int64)
    size = np.diff(np.append(begin, len(doc)))
    order = np.argsort(-size, kind="stable")
    begin, size = begin[order], size[order]
    return [begin[: np.searchsorted(-size, -t, side="left")] + t for t in range(int(size[0]) if len(size) else 0)]


def viterbi(model: LineModel, features: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Best label of every line; the texts of a block step on together."""
    score = features @ model.unary
    steps = _by_step(doc)
    best, back = score.copy(), np.zeros((len(score), 2), dtype=np.int64)
    for before, now in zip(steps, steps[1:], strict=False):
        come = best[before[: len(now)], :, None] + model.transition
        back[now] = come.argmax(axis=1)
        best[now] = score[now] + come.max(axis=1)
    label = best.argmax(axis=1)
    for t in range(len(steps) - 1, 0, -1):
        now = steps[t]
        label[now - 1] = back[now, label[now]]
    return label


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


def train(features: np.ndarray, doc: np.ndarray, label: np.ndarray, rounds: int = 300,
          rate: float = 0.1, ridge: float = 1e-3, stay: float = 0.03) -> LineModel:
    """Maximum likelihood of the chains: forward-backward gradients, Adam steps.

    Both labels weigh alike, however rare one is in the sample.  Features are
    scaled to unit spread while training; the weights returned fit them as
    they are.  ``stay`` holds the transitions back: the training labels never
    change within a document, but lines of real documents do.
    """
    if not len(label) or len(np.unique(label)) < 2:
        return LineModel.fallback()
    centre, spread = features.mean(axis=0), features.std(axis=0)
    centre[0], spread[0] = 0.0, 1.0  # the bias
    spread[spread < 1e-6] = 1.0
    features = (features - centre) / spread
    steps, k = _by_step(doc), features.shape[1]
    truth = np.eye(2)[label]
    weight = np.where(label == 0, 0.5 / (label == 0).mean(), 0.5 / (label == 1).mean())
    theta, m, v = np.zeros((k + 2, 2)), np.zeros((k + 2, 2)), np.zeros((k + 2, 2))
    for it in range(1, rounds + 1):
        unary, trans = theta[:k], theta[k:]
        score = features @ unary
        fore, aft = score.copy(), np.zeros_like(score)
        for before, now in zip(steps, steps[1:], strict=False):
            fore[now] += _lse(fore[before[: len(now)], :, None] + trans, 1)
        for t in range(len(steps) - 2, -1, -1):
            now = steps[t + 1]
            aft[steps[t][: len(now)]] = _lse(trans + (score[now] + aft[now])[:, None, :], 2)
        post = fore + aft
        post = np.exp(post - _lse(post, 1)[:, None])
        grad = np.zeros_like(theta)
        grad[:k] = features.T @ ((truth - post) * weight[:, None])
        for before, now in zip(steps, steps[1:], strict=False):
            before = before[: len(now)]
            pair = fore[before][:, :, None] + trans + (score[now] + aft[now])[:, None, :]
            pair = np.exp(pair - _lse(pair.reshape(-1, 4), 1)[:, None, None])
            grad[k:] += ((truth[before][:, :, None] * truth[now][:, None, :] - pair)
                         * weight[now][:, None, None]).sum(axis=0)
        grad = grad / len(label) - ridge * theta
        grad[k:] -= stay * theta[k:]
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        theta = theta + rate * (m / (1 - 0.9 ** it)) / (np.sqrt(v / (1 - 0.99 ** it)) + 1e-8)
    unary = theta[:k] / spread[:, None]
    unary[0] -= (centre[:, None] * unary).sum(axis=0)
    return LineModel(unary, theta[k:].copy())


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, buf, offsets in B.slices(batches, "__text"):
        _, features, doc, _ = measure(buf, offsets)
        begin = np.searchsorted(doc, np.arange(len(offsets)))
        flat = pa.array(features.astype(np.float32).ravel())
        yield pa.RecordBatch.from_arrays(
            [rows.column(0), rows.column(1),
             pa.ListArray.from_arrays(pa.array((begin * len(FEATURES)).astype(np.int32)), flat)],
            names=["key", "quality", "features"])


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", quality: str = "quality",
        train_docs: int = TRAIN_DOCS) -> LineModel:
    """Train on at most ``train_docs`` labelled documents (smallest id hashes).

    Only line features reach the driver, of documents up to ``TRAIN_CHARS``
    characters; a document labelled twice counts as its worse label, and an id
    on several rows as the one with the smallest text hash.
    """
    store.prepare(docs.sparkSession)
    marks = (labels.filter(F.col(quality).isNotNull() & F.col(doc_id).isNotNull()).groupBy(doc_id)
             .agg(F.min(quality).alias("__quality")))
    take = (docs.select(F.col(doc_id).alias("__doc"), F.length(text).alias("__len"))
            .filter(F.col("__len").between(1, TRAIN_CHARS))
            .join(marks.withColumnRenamed(doc_id, "__doc"), "__doc")
            .select("__doc", "__quality").distinct().orderBy(F.xxhash64("__doc"), "__doc").limit(train_docs))
    # At most ``train_docs`` ids: a bounded set, so the texts are not shuffled.
    one = F.min(F.struct(F.xxhash64("__text").alias("hash"), "__text")).alias("__one")
    rows = (docs.select(F.col(doc_id).alias("__doc"), F.col(text).alias("__text"))
            .filter(F.length("__text").between(1, TRAIN_CHARS)).join(F.broadcast(take), "__doc")
            .groupBy("__doc", "__quality").agg(one)
            .select(F.col("__doc").cast("string").alias("key"), F.col("__quality").cast("int").alias("quality"), "__one.__text")
            .mapInArrow(_lines, "key string, quality int, features array<float>").collect())
    feats, doc, label = [], [], []
    for i, r in enumerate(sorted(rows, key=lambda r: (r.key, r.quality, r.features))):
        x = np.asarray(r.features, dtype=np.float64).reshape(-1, len(FEATURES))
        feats.append(x)
        doc.append(np.full(len(x), i))
        label.append(np.full(len(x), CONTENT if r.quality > 0 else BOILERPLATE))
    if not feats:
        return LineModel.fallback()
    return train(np.concatenate(feats), np.concatenate(doc), np.concatenate(label))


_TYPES = {"long": LongType, "boolean": BooleanType, "double": DoubleType}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge(docs: DataFrame, model: LineModel, text: str = "text", min_share: float = MIN_CONTENT_SHARE,
          prefix: str = "") -> DataFrame:
    """The input columns plus the measures, base_failed, content_share and kept.

    Input columns with these names are replaced.
    """
    store.prepare(docs.sparkSession)
    docs = store.clear(docs, *(prefix + c for c in (*MEASURES, "base_failed", "content_share", "kept")))
    more = [*((c, "long") for c in MEASURES), ("base_failed", "boolean"), ("content_share", "double"), ("kept", "boolean")]
    schema = StructType(docs.schema.fields + [StructField(prefix + c, _TYPES[t]()) for c, t in more])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, offsets in B.slices(batches, text):
            base, features, doc, words = measure(buf, offsets)
            content = viterbi(model, features, doc) == CONTENT
            good = np.bincount(doc[content], weights=words[content], minlength=rows.num_rows)
            total = base["n_words"]
            share = good / np.maximum(total, 1)
            failed = (total < MIN_WORDS) | (100 * base["n_repeat_words"] > MAX_REPEAT_PERCENT * total)
            cols = [pa.array(base[c].astype(np.int64)) for c in MEASURES]
            cols += [pa.array(failed), pa.array(share), pa.array(~failed & (share >= min_share))]
            yield pa.RecordBatch.from_arrays([*rows.columns, *cols], names=names)

    return docs.mapInArrow(run, schema)

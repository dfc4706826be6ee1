"""Repeated-substring removal against counting every substring."""

import collections
import hashlib
import random

import numpy as np
import pytest

from shelfline.llm import suffix_dedup as D

SCHEMA = "doc_id long, text string"


def brute(rows, length):
    count = collections.Counter()
    texts = [(d, (t or "").encode()) for d, t in rows]
    for _, b in texts:
        count.update(b[i:i + length] for i in range(len(b) - length + 1))
    out = []
    for d, b in texts:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if count[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df, **kw):
    rows = D.remove_repeats(df, **kw).collect()
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows), key=str)


def corpus():
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randint(2, 6))) for _ in range(50)]
    some = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    base = [some(rnd.randint(5, 100)) for _ in range(25)]
    rows = []
    for i in range(80):
        t = rnd.choice(base)
        for _ in range(rnd.randint(0, 3)):
            p = rnd.randint(0, len(t))
            t = t[:p] + rnd.choice(["x", "zz", "", some(8), rnd.choice(base)[: rnd.randint(20, 200)]]) + t[p:]
        rows.append((i if i % 17 else None, t))
    rows += [(900, None), (901, ""), (902, "a" * 300), (903, "b" * 200 + "a" * 150), (904, "ab" * 120), (904, "ab" * 120),
             (905, "c" * 64), (906, "d" * 65), (907, "e" * 63)]
    return rows


@pytest.mark.parametrize(("length", "bucket_classes"), [(64, 2048), (64, 1), (40, 3)])
def test_equals_brute_force(frame, length, bucket_classes):
    rows = corpus()
    assert got(frame(rows, SCHEMA), length=length, bucket_classes=bucket_classes) == brute(rows, length)


def test_production_length(frame):
    rnd = random.Random(5)
    make = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    shared = make(430)
    rows = [(1, make(500) + shared + make(100)), (2, make(20) + shared), (3, shared[:399]), (4, shared[10:]), (5, make(3000))]
    result = got(frame(rows, SCHEMA))
    assert result == brute(rows, 400)
    assert [r[2] for r in result] == [430, 430, 0, 420, 0]


def test_kept_text_and_empty_table(frame, spark):
    rows = [(1, "q" * 10 + "0123456789" * 7), (2, "0123456789" * 7 + "ü")]
    made = {r.doc_id: bytes(r.kept).decode() for r in
            D.remove_repeats(frame(rows, SCHEMA), length=64, want_text=True).collect()}
    assert made == {1: "q" * 10, 2: "ü"}
    assert D.remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_segments_of_long_texts_agree_across_steps(monkeypatch):
    text = np.frombuffer(bytes(random.Random(1).choices(b"abc", k=5000)), dtype=np.uint8)
    whole = D.segments(text, 64)
    monkeypatch.setattr(D, "_STEP", 700)
    parts = D.segments(text, 64)
    strings = lambda s: {int(lo) + i: int(h) for lo, n, h in zip(*s[:3], strict=True) for i in range(n)}
    assert strings(whole) == strings(parts)


def test_kept_columns_named_like_results(frame):
    rows = [(1, "abcdefgh" * 3, 5, "a", "b"), (2, "zz" + "abcdefgh" * 3, 6, None, "c"), (3, None, 7, "a", None)]
    docs = frame(rows, "doc_id long, text string, n_bytes int, KEPT string, more string")
    out = D.remove_repeats(docs, keep=("doc_id", "n_bytes", "KEPT", "more", "text"), length=8, want_text=True)
    assert out.columns == ["doc_id", "more", "text", *(c for c, _ in D.RESULT)]
    assert sorted((r.doc_id, r.more, r.n_bytes, bytes(r.kept)) for r in out.collect()) == [
        (1, "b", 24, b""), (2, "c", 26, b"zz"), (3, None, 0, b"")]

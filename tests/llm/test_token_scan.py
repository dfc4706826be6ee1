"""Separator scan against splitting the whole stream."""

import numpy as np
import pytest

from shelfline.llm import bpe, token_scan as T

END = 7


def blocks_of(streams, size):
    rows = []
    for name, ids in streams.items():
        data = np.array(ids, dtype="<u2").tobytes()
        rows += [(name, i // (2 * size), bytearray(data[i:i + 2 * size])) for i in range(0, max(len(data), 1), 2 * size)]
    return rows


def brute(streams):
    out = []
    for name, ids in streams.items():
        start, n = 0, 0
        for i, x in enumerate(ids):
            if x == END:
                out.append((name, n, start, i - start, True))
                start, n = i + 1, n + 1
        if start < len(ids):
            out.append((name, n, start, len(ids) - start, False))
    return sorted(out)


STREAMS = {
    1: [1, 2, 3, END, 4, END, END, 5, 5, 5, 5, 5, 5, 5, 5, 5, 5, 5, END], 2: [], 3: [END], 4: [1, 2, 3], 5: [END, END, 9],
    6: list(np.random.default_rng(3).integers(0, 12, 500)), 7: [3] * 100 + [END] + [2] * 50,
}


@pytest.mark.parametrize(("size", "stride"), [(1, 4), (3, 7), (3, T.STRIDE), (16, 2), (1000, T.STRIDE)])
def test_scan_equals_split(frame, size, stride, monkeypatch):
    monkeypatch.setattr(T, "STRIDE", stride)
    found = T.scan(frame(blocks_of(STREAMS, size), "file long, block long, data binary"), END)
    assert sorted(map(tuple, found.collect())) == brute(STREAMS)


def test_flat_files(spark, tmp_path):
    for name, ids in STREAMS.items():
        (tmp_path / f"{name}.bin").write_bytes(np.array(ids, dtype="<u2").tobytes())
    found = T.scan(T.read_files(spark, str(tmp_path), block_tokens=10), END)
    rows = sorted((int(r.file.rsplit("/", 1)[1][:-4]), r.ordinal, r.start, r.n_tokens, r.terminated) for r in found.collect())
    assert rows == brute(STREAMS)


@pytest.mark.parametrize("size", [5, 1 << 18])
def test_documents_round_trip(frame, vocabulary, size):
    texts = ["hello world", "", None, "one two three four five six seven", "x" * 400, "a b", "a b"]
    docs = frame([(i if i != 5 else None, t) for i, t in enumerate(texts)], "doc_id long, text string")
    blocks = T.write_blocks(docs, *vocabulary, 50256, block_tokens=size).cache()
    rows = T.scan(blocks, 50256).join(T.manifest(blocks), ["file", "ordinal"]).collect()
    encoder = bpe.TextEncoder(bpe.read_ranks(vocabulary[0]), vocabulary[1])
    want = sorted((i if i != 5 else -1, len(encoder([t])[0])) for i, t in enumerate(texts))
    assert sorted((-1 if r.key is None else r.key, r.n_tokens) for r in rows) == want
    assert all(r.terminated for r in rows)


def test_documents_with_text_ids_and_clashing_columns(frame, vocabulary, monkeypatch):
    monkeypatch.setattr(T, "STRIDE", 2)
    rows = [(f"d{i}", "one two three " * i, i, "x") for i in range(9)] + [("d3", "", 0, "x"), (None, None, 0, None)]
    docs = frame(rows, "name string, text string, file int, key string")
    blocks = T.write_blocks(docs, *vocabulary, 50256, key="name", block_tokens=7).cache()
    found = T.scan(blocks, 50256).join(T.manifest(blocks), ["file", "ordinal"]).collect()
    encoder = bpe.TextEncoder(bpe.read_ranks(vocabulary[0]), vocabulary[1])
    assert sorted((r.key or "", r.n_tokens) for r in found) == sorted((n or "", len(encoder([t])[0])) for n, t, *_ in rows)


def test_files_of_many_splits(spark, tmp_path):
    """Blocks put together from pieces of several splits, at odd places."""
    ids = np.random.default_rng(5).integers(0, 40, 20_000)
    (tmp_path / "a.bin").write_bytes(ids.astype("<u2").tobytes())
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3001")
    try:
        found = {r.block: bytes(r.data) for r in T.read_files(spark, str(tmp_path), block_tokens=900).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted(found) == list(range(23))
    assert b"".join(found[i] for i in sorted(found)) == ids.astype("<u2").tobytes()


def test_odd_blocks(spark, vocabulary):
    with pytest.raises(Exception, match="whole ids"):
        T.scan(spark.createDataFrame([(1, 0, bytearray(b"abc"))], "file long, block long, data binary"), END).collect()
    assert T.scan(spark.createDataFrame([], "file long, block long, data binary"), END).count() == 0
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert T.write_blocks(docs, *vocabulary, 50256).count() == 0
    with pytest.raises(ValueError, match="fit"):
        T.write_blocks(docs, *vocabulary, 70000)

"""Merge replay against the tokenizer library; decoding is an exact round trip."""

import hashlib

import numpy as np
import pytest

from shelfline.llm import bpe

TEXTS = [
    "", " ", "hello world", " a  b   c ", "don't we'll they've I'm", "x\x1cy\x85z \n\n a\t\t\tb", "日本語 テスト 123٣ ½²",
    "😀😀 ok <|endoftext|>", "aaaaaaa" * 300, "aaab" * 2000, " " * 3000 + "x", "ǅ ʰx ß Straße ÉTÉ", "é" * 50, "\u2028a\u3000b",
    "1234567 89", "a\x00b", "ééèè eauxeaux tionstion",
]


@pytest.fixture(scope="module")
def library():
    tiktoken = pytest.importorskip("tiktoken")
    public_tokenizers = pytest.importorskip("public_tokenizers")
    tokens = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)},
                             special_tokens={})


def test_equals_library(frame, vocabulary, library):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(100, None, "x"), (None, "twice twice", "x"), (None, "twice twice", "x")]
    coded = bpe.encode(frame(rows, "doc_id long, text string, ids string"), *vocabulary)
    assert coded.columns == ["doc_id", "text", "ids"]
    back = bpe.decode(coded, vocabulary[0]).collect()
    assert len(back) == len(rows)
    for r in back:
        assert list(r.ids) == library.encode_ordinary(r.text or "")
        assert bytes(r.bytes) == (r.text or "").encode()


def test_documents(spark, vocabulary, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = bpe.encode(docs, *vocabulary).select("text", "ids", bpe.id_digest("ids").alias("digest")).collect()
    for r in rows:
        want = library.encode_ordinary(r.text)
        assert list(r.ids) == want
        assert r.digest == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()


def reference(tokens, word):
    """One merge at a time: the leftmost pair of lowest rank."""
    rank = {t: i for i, t in enumerate(tokens)}
    if word in rank:
        return [rank[word]]
    parts = [bytes([b]) for b in word]
    while True:
        pairs = [(rank[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in rank]
        if not pairs:
            return [rank[p] for p in parts]
        _, i = min(pairs)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


def test_odd_rank_orders():
    """Ranks where a merge can make a pair of lower rank."""
    rng = np.random.default_rng(4)
    more = [bytes(rng.choice(list(b"abc"), n)) for n in (2, 2, 2, 3, 3, 3, 4, 4, 5, 6) for _ in range(4)]
    for _ in range(20):
        own = list(dict.fromkeys(more[i] for i in rng.permutation(len(more))))
        tokens = own + [bytes([b]) for b in range(256)]
        words = [bytes(rng.choice(list(b"abcd"), rng.integers(1, 30))) for _ in range(60)]
        ids, offsets = bpe.MergeReplay(tokens).encode(words)
        for i, w in enumerate(words):
            assert ids[offsets[i]: offsets[i + 1]].tolist() == reference(tokens, w)


def test_memory_bound_forgets(vocabulary, monkeypatch, library):
    monkeypatch.setattr(bpe, "REMEMBER", 3)
    encoder = bpe.TextEncoder(bpe.read_ranks(vocabulary[0]), vocabulary[1])
    for t in TEXTS:
        ids, offsets = encoder([t, None, t])
        assert ids[: offsets[1]].tolist() == ids[offsets[2]:].tolist() == library.encode_ordinary(t)


def test_empty_and_unknown(spark, vocabulary):
    assert bpe.encode(spark.createDataFrame([], "text string"), *vocabulary).count() == 0
    with pytest.raises(Exception, match="not in the vocabulary"):
        bpe.decode(spark.createDataFrame([([99999999],)], "ids array<int>"), vocabulary[0]).collect()

"""N-grams, filter corrections, held-out accuracy."""

import collections
import zlib

import numpy as np
from pyspark.sql import functions as F

from shelfline.llm import langid as L


def block(texts):
    data = [t.encode() for t in texts]
    return np.frombuffer(b"".join(data), np.uint8), np.concatenate([[0], np.cumsum([len(d) for d in data])])


def test_grams_equal_brute_force():
    texts = ["", "Hi there, you!", "123", "É tu", "a", "one  two\nthree", "x9y"]
    packed, owner = L.grams(*block(texts))
    got = collections.Counter(zip(owner.tolist(), packed.tolist(), strict=True))
    want = collections.Counter()
    for i, t in enumerate(texts):
        low = bytes(b + 32 if 65 <= b <= 90 else b for b in t.encode())
        words = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in low).split()
        s = b" " + b" ".join(words) + b" " if words else b""
        want.update((i, int.from_bytes(s[j:j + 5], "big")) for j in range(len(s) - 4))
    assert got == want


def test_documents_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    test = L.held_out(F.col("doc_id"))
    filters = L.train(docs.filter(~test))
    rows = L.predict(docs, filters).withColumn("held", test).collect()
    assert all(r.held == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held and r.lang]
    assert sum(r.lang == r.lang_pred for r in held) / len(held) >= 0.98
    assert all(0 <= r.score <= 1 for r in rows)
    assert np.all(filters.false_rate < 0.05)


def test_false_positives_are_corrected():
    """A crowded filter: a language that holds nothing of a text scores about 0."""
    rng = np.random.default_rng(0)
    own = rng.integers(0, 1 << 40, 900)
    masks = np.zeros(1024, dtype=np.uint64)
    for place in L.places(own, 1024):
        masks[place] |= np.uint64(2)
    fill = np.array([0.0, np.mean(masks >> np.uint64(1) & np.uint64(1))])
    filters = L.Filters(["a", "b"], masks, fill ** L.HASHES)
    other = rng.integers(0, 1 << 40, 20000)
    hits = np.mean(filters.lookup(other) >> np.uint64(1) & np.uint64(1))
    assert abs(hits - filters.false_rate[1]) < 0.02 < hits


def test_defined_cases(spark):
    rows = [(1, "alpha beta gamma delta", "xx"), (2, "uno dos tres cuatro", "yy"), (3, "alpha beta", "xx"), (4, None, "yy"), (5, "uno", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    filters = L.train(docs)
    ask = spark.createDataFrame([(1, None, 1), (2, "", 1), (3, "123 !!", 1), (4, "gamma beta", 1), (None, "tres dos uno", 1),
                                 (None, "tres dos uno", 1), (6, "zzzzzz qqqqqq", 1), (7, "tres " * 100_000, 1)],
                                "doc_id long, text string, score int")
    got = [(r.doc_id, r.lang_pred, r.score) for r in L.predict(ask, filters).collect()]
    assert got[:3] == [(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0)]
    assert [g[1] for g in got[3:]] == ["xx", "yy", "yy", "xx", "yy"]
    assert got[6][2] == 0.0
    none = L.train(docs.filter("lang IS NULL"))
    assert {r.lang_pred for r in L.predict(ask, none).collect()} == {"und"}
    assert L.predict(ask.limit(0), filters).count() == 0


def test_sample_is_bounded_and_repeats_do_not_fill_it(spark):
    """Texts in hash order until the bound; a group of copies counts once; longer texts do not train."""
    texts = [f"{w} is the word of row {w}" for w in ("anna", "berta", "carla", "dora", "emil", "frida", "gustav", "hilde")]
    rows = [(t, "xx") for t in texts] + [(texts[0], "xx")] * 50 + [("long " * 100, "xx"), ("solo", "yy")]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    every = L.train(docs)
    assert every.languages == ["xx", "yy"]
    known = [bool(every.lookup(L.grams(*block([t]))[0]).all()) for t in texts]
    assert all(known)

    def learnt(chars):
        few = L.train(docs, train_chars=chars)
        assert few.languages == ["xx", "yy"]
        return {t for t in {t for t, _ in rows} if (few.lookup(L.grams(*block([t]))[0]) & np.uint64(1)).all()}

    order = [r.text for r in docs.filter("lang = 'xx' AND length(text) <= 60").select("text").distinct()
             .orderBy(F.xxhash64("text")).collect()]
    one = learnt(60)
    assert 1 <= len(one & set(texts)) <= 3
    assert one & set(texts) == set(order[:len(one & set(texts))])
    assert "long " * 100 not in one
    assert set(texts) <= learnt(480)


def test_short_texts(spark):
    """The first ten words of held-out documents: most are still told apart."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    test = L.held_out(F.col("doc_id"))
    short = docs.filter(test & F.col("lang").isNotNull()).withColumn(
        "text", F.array_join(F.slice(F.split(F.trim("text"), r"\s+"), 1, 10), " ")).filter(F.col("text").rlike(r"\p{L}"))
    rows = L.predict(short, L.train(docs.filter(~test))).collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) >= 0.95

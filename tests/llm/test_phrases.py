"""Collocations against counting every phrase in plain Python."""

import collections
import random
import re

import pytest

from shelfline.llm import phrases as P

SCHEMA = "doc_id long, text string, lang string, a long, phrase string"


def brute(rows, support, longest=4, contained=80, top=2000):
    count = collections.Counter()
    n = collections.Counter()
    for _, text, lang, *_ in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                count.update((lang, tuple(w[i: i + k])) for i in range(len(w) - k + 1))
    cands = {k: a for k, a in count.items() if len(k[1]) > 1 and a >= support}
    gone = {(lang, p[i:j]) for (lang, p), f in cands.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
            if j - i < len(p) and 100 * f >= contained * cands[lang, p[i:j]]}
    best = collections.defaultdict(list)
    for (lang, p), a in cands.items():
        if (lang, p) in gone:
            continue
        s, _, left, right = min((2_000_000 * a // (count[lang, p[:k]] + count[lang, p[k:]]), k, count[lang, p[:k]], count[lang, p[k:]])
                                for k in range(1, len(p)))
        best[lang].append((-s, -a, " ".join(p).encode(), left, right))
    return sorted(((lang, i, p.decode(), -a, left, right, n[lang], -s) for lang, x in best.items()
                   for i, (s, a, p, left, right) in enumerate(sorted(x)[:top], 1)), key=str)


def got(df, **kw):
    return sorted((tuple(r) for r in P.collocations(df, **kw).collect()), key=str)


def corpus(n=120):
    rnd = random.Random(11)
    words = ["der", "Die", "das", "é", "NEW", "york", "city", "x-y", "a'b", " z", "\x00", "q" * 300]
    ends = [" ", " ", "  ", "\t", ". ", ",", "\n", "!?", " \r\n", ";"]
    rows = []
    for i in range(n):
        t = "".join(rnd.choice(words) + rnd.choice(ends) for _ in range(rnd.randint(0, 60)))
        if i % 5 == 0:
            t += " the Quick brown fox"
        rows.append((i, t, rnd.choice(["de", "en", None, "und"]), 1, "x"))
    return rows + [(1, None, "de", None, None), (None, "", None, 2, "y"), (2, "lonely words here", "fr", 0, ""),
                   (3, " ".join(["again"] * 50), "fr", 0, ""), (3, " ".join(["again"] * 50), "fr", 0, "")]


@pytest.mark.parametrize(("shards", "support", "top", "bits"), [(1, 5, 2000, 26), (3, 5, 2000, 8), (6, 30, 7, 26), (50, 4, 3, 12)])
def test_equals_brute_force(frame, shards, support, top, bits):
    rows = corpus()
    want = brute(rows, support, top=top)
    assert want
    assert got(frame(rows, SCHEMA), shards=shards, support=support, top=top, bitmap_bits=bits) == want


def test_blocks_and_long_texts(frame, monkeypatch):
    rows = [*corpus(30), (7, " ".join(f"w{i % 40} of the" for i in range(20_000)), "en", 1, "")]
    assert got(frame(rows, SCHEMA), support=10) == brute(rows, 10)


def test_nothing_to_count(frame):
    assert got(frame([], SCHEMA)) == []
    assert got(frame([(1, None, None, None, None), (2, " . ", "en", 1, "")], SCHEMA)) == []


def test_score_is_exact_beyond_64_bits(spark):
    big = 9_000_000_000_000_000_001
    counts = spark.createDataFrame([("en", 1, "a", big), ("en", 1, "b", 9_223_372_036_854_775_807), ("en", 2, "a b", big - 4)],
                                   "lang string, words int, phrase string, a long")
    (r,) = P.score(counts).collect()
    assert (r.l, r.r, r.score) == (big, 2**63 - 1, 2_000_000 * (big - 4) // (big + 2**63 - 1))


def test_query_equals_sql(spark):
    import duckdb

    from shelfline.llm import queries

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = con.execute(queries.ORACLE["op13_phrases"]).fetchall()
    assert sorted(map(tuple, queries.op13_phrases(spark, sf).collect())) == sorted(want)
    docs = [(r.doc_id, r.text, "und" if r.lang is None else r.lang) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted(want, key=str) == brute(docs, 30)

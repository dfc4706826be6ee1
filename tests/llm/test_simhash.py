"""SimHash fingerprints and components against comparing all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash

from shelfline.llm import simhash as S

SCHEMA = "doc_id long, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fingerprint(text, k=4):
    w = WORD.findall((text or "").translate(LOWER))
    grams = [" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))] if w else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def brute_components(fps, bits=4):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    fps = sorted(set(fps))
    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if (a ^ b).bit_count() <= bits:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {f: find(f) for f in fps}


def test_documents_equal_brute_force(frame):
    rnd = random.Random(8)
    vocab = [f"Wörd{i}" for i in range(60)]
    rows = []
    for i in range(60):
        base = [rnd.choice(vocab) for _ in range(rnd.randint(0, 120))]
        for _ in range(rnd.randint(1, 3)):
            t = list(base)
            for _ in range(rnd.randint(0, 2)):
                if t:
                    t[rnd.randrange(len(t))] = rnd.choice(vocab)
            rows.append((len(rows) if i % 9 else None, rnd.choice([" ", "  ", "\n"]).join(t)))
    rows += [(900, None), (901, ""), (902, " \t"), (903, "one two"), (904, "ONE  two"), (904, "ONE  two")]
    out = S.components(frame(rows, SCHEMA)).collect()
    assert len(out) == len(rows)
    groups = brute_components([fingerprint(t) for _, t in rows])
    low = {}
    for d, t in rows:
        g = groups[fingerprint(t)]
        low[g] = min((x for x in (low.get(g), d) if x is not None), default=None)
    want = sorted(((d, fingerprint(t), low[groups[fingerprint(t)]]) for d, t in rows), key=str)
    assert sorted(((r.doc_id, r.fingerprint % (1 << 64), r.component_id) for r in out), key=str) == want


@pytest.mark.parametrize("bucket_rows", [S.BUCKET_ROWS, 3])
def test_links_connect_what_is_near(spark, bucket_rows):
    """Clusters around centres, with chains: components equal those of all pairs."""
    rng = np.random.default_rng(6)
    fps = set()
    for _ in range(25):
        f = int(rng.integers(0, 1 << 63))
        for _ in range(rng.integers(1, 30)):
            for b in rng.choice(64, rng.integers(0, 7), replace=False):
                f ^= 1 << int(b)
            fps.add(f % (1 << 64))
    fps |= {0, 1, 15, (1 << 64) - 1}
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    df = spark.createDataFrame(signed, "fp long").repartition(4)
    roots = {r.node % (1 << 64): r.root % (1 << 64) for r in S.connected(S.links(df, bucket_rows=bucket_rows)).collect()}
    want = brute_components(fps)
    groups = lambda m: {frozenset(x for x in fps if m(x) == r) for r in {m(x) for x in fps}}
    assert groups(lambda x: roots.get(x, x)) == groups(lambda x: want[x])


def test_segments_miss_no_pair():
    """Every difference of up to 4 bits is within radius in some segment."""
    rng = np.random.default_rng(1)
    for _ in range(3000):
        bits = rng.choice(64, rng.integers(1, 5), replace=False)
        assert any(sum(low <= b < low + width for b in bits) <= radius for low, width, radius in S.SEGMENTS)


def test_connected_long_chain(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (5, 5)]
    out = {r.node: r.root for r in S.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert out == {**{i: 0 for i in range(1, 61)}, 101: 100}


def test_keep_one(frame):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(5, text), (2, text), (2, text), (None, text), (9, "other words that differ from all"), (None, None), (None, "")]
    kept = S.keep_one(frame([(*r, 1) for r in rows], SCHEMA + ", __row int")).collect()
    assert sorted(((r.doc_id, r.text or "") for r in kept), key=str) == sorted([(2, text), (9, rows[4][1]), (None, "")], key=str)


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert S.components(empty).count() == 0
    assert S.keep_one(empty).count() == 0
    with pytest.raises(ValueError, match="at most"):
        S.links(spark.createDataFrame([], "fp long"), max_bits=5)
    for odd in (1, 3):
        with pytest.raises(ValueError, match="even"):
            S.links(spark.createDataFrame([], "fp long"), max_bits=odd)


@pytest.mark.parametrize("bucket_rows", [S.BUCKET_ROWS, 1])
def test_two_bits_lose_no_link_in_large_buckets(spark, bucket_rows):
    far = [0x123456789ABCDEF0, 0x7EDCBA9876543210, 0x0F1E2D3C4B5A6978, 0x5555AAAA3333CCCC]
    pairs = [(x, x ^ mask) for x, mask in zip(far, (3, 5 << 40, 1 << 62, 7), strict=True)]
    df = spark.createDataFrame([(x,) for p in pairs for x in p], "fp long")
    roots = {r.node: r.root for r in S.connected(S.links(df, max_bits=2, bucket_rows=bucket_rows)).collect()}
    same = [roots.get(a, a) == roots.get(b, b) for a, b in pairs]
    assert same == [True, True, True, False]


def test_kept_columns_named_like_results(frame):
    rows = [(1, "a b c d e f", 7, "x", 1.5, "y"), (2, "a b c d e f", 8, "x", 2.5, None), (3, None, 9, None, None, None)]
    docs = frame(rows, "doc_id long, text string, component_id int, Fingerprint string, root double, Text2 string")
    out = S.components(docs, keep=("component_id", "Fingerprint", "root", "Text2", "text"))
    assert out.columns == ["doc_id", "Text2", "text", "fingerprint", "component_id", "root"]
    assert sorted((r.doc_id, r.component_id, r.Text2) for r in out.collect()) == [(1, 1, "y"), (2, 1, None), (3, 3, None)]
    assert sorted(r.component_id for r in S.keep_one(docs).collect()) == [7, 9]

"""Packing against plain encoding, a plain first-fit, and the padding rule."""

import random
import zlib

import pytest

from shelfline.llm import packing as P

SCHEMA = "doc_id long, text string, start string, offset long"


@pytest.fixture(scope="module")
def spec():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        return f.read()


@pytest.fixture(scope="module")
def tokenizer(spec):
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(spec)
    t.encode_special_tokens = True
    return t


def texts():
    rnd = random.Random(5)
    words = ["".join(rnd.choice("abcdefgé'sß.,!") for _ in range(rnd.randint(1, 9))) for _ in range(300)]
    some = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    out = [some(rnd.randint(0, 120)) for _ in range(150)]
    out += ["", None, "áb é\ńx", "I'LL don't ΣΑΣ Ünïcode x\x1cy", "<|endoftext|> <|startoftext|>", "  \t\r\n ",
            "東京タワー 123 ①²", some(5000), "z" * 30_000, "İstanbul ǅ ﬁ", "word,$$$ É... İ, é, e\u0301, I\u0307. x\u0307, 5!! »,, don't. a-b- ’s, ①. ½; 's' A'S,"]
    return out + out[:3] * 4


def check(rows, docs, tokenizer, size):
    """Every id in exactly one piece, gapless sequences, padding at powers of two only."""
    want = sorted([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for _, t in docs)
    sequences = {}
    for r in rows:
        assert r["length"] * 4 == len(r.ids) > 0
        sequences.setdefault(r.sequence_id, []).append((r.offset, r["length"]))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= size
        assert at & (at - 1) == 0  # full or a power of two: no padding anywhere
    per_doc = {}
    for r in rows:
        per_doc.setdefault(r.doc_id, []).append(r)
    for pieces in per_doc.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["start"]):
            assert p["start"] == at
            at += p["length"]
        assert at == pieces[0].doc_tokens
    assert sorted(sum((memoryview(p.ids).cast("I").tolist() for p in sorted(x, key=lambda p: p["start"])), [])
                  for x in per_doc.values()) == want


@pytest.mark.parametrize(("size", "group_docs"), [(64, 7), (2048, 2048), (16, 1000)])
def test_each_id_in_one_piece(frame, spec, tokenizer, size, group_docs):
    docs = list(enumerate(texts()))
    df = frame([(i, t, "x", 1) for i, t in docs], SCHEMA)
    rows = P.pack(df, spec, size=size, group_docs=group_docs, keep=("doc_id", "start", "offset")).collect()
    check(rows, docs, tokenizer, size)


def test_null_and_repeated_ids(frame, spec):
    df = frame([(None, "one two"), (None, None), (3, "one two"), (3, "one two")], "doc_id long, text string")
    rows = P.pack(df, spec).collect()
    assert sum(r["length"] for r in rows) == 3 * 3 + 1
    assert {r.doc_tokens for r in rows if r.doc_id == 3} == {3}


def test_empty_table(frame, spec):
    out = P.pack(frame([], "doc_id long, text string"), spec)
    assert out.collect() == []
    assert out.columns == ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]


def test_tree_gives_first_fit():
    rnd = random.Random(1)
    for n in (0, 1, 2, 17, 200):
        lengths = [rnd.randint(1, 63) for _ in range(n)]
        bins, free = [], []
        for i in sorted(range(n), key=lambda i: (-lengths[i], i)):
            at = next((b for b, f in enumerate(free) if f >= lengths[i]), len(free))
            if at == len(free):
                free.append(64)
                bins.append([])
            free[at] -= lengths[i]
            bins[at].append(i)
        assert P.first_fit_decreasing(lengths, 64) == bins
        closed = P.close_gaps(bins, lengths, 64)
        assert all((s := sum(p[2] for p in q)) <= 64 and s & (s - 1) == 0 for q in closed)
        cut = sorted(x for q in closed for x in q)
        for i in range(n):
            mine = [(a, b) for j, a, b in cut if j == i]
            assert [a for a, _ in mine] == [sum(b for _, b in mine[:k]) for k in range(len(mine))]
            assert sum(b for _, b in mine) == lengths[i]


def test_small_cache_gives_the_same(spec, tokenizer, monkeypatch):
    monkeypatch.setattr(P, "CACHE_BYTES", 100)
    monkeypatch.setattr(P, "_STEP_WORDS", 7)
    coder = P.WordEncoder(spec)
    for t in texts():
        ids = memoryview(coder.encode((t or "").encode())).cast("I").tolist()
        assert ids == tokenizer.encode(t or "", add_special_tokens=False).ids


def test_new_words_go_to_the_tokenizer_together(spec, tokenizer):
    """One call text per word was most of the query's time; letters that fold into a letter and a mark are taken singly."""
    rnd = random.Random(9)
    words = list({"".join(rnd.choice("abcdeéßñдж東") for _ in range(rnd.randint(1, 9))) for _ in range(3000)})
    coder = P.WordEncoder(spec)
    plain, sent = coder._tokenizer, []

    class Counting:
        def encode_batch_fast(self, texts, **kw):
            sent.extend(texts)
            return plain.encode_batch_fast(texts, **kw)

    coder._tokenizer = Counting()
    for text in (" ".join(words), "İstanbul aİ xyz \u0958\u0915 \u1112\u1161 \u1161 K Å end", " ".join(words[::-1])):
        ids = memoryview(coder.encode(text.encode())).cast("I").tolist()
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids
    assert len(sent) < len(words) / 50


def test_ids_of_many_texts(spec, tokenizer, monkeypatch):
    import pyarrow as pa

    own = [*texts(), " a  b\n", "\xa0", "\x85 \u3000x"]
    want = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in own]
    for step in (P._STEP_WORDS, 5):
        monkeypatch.setattr(P, "_STEP_WORDS", step)
        coder = P.WordEncoder(spec)
        for block in (pa.array(own), pa.array(["z", *own])[1:], pa.array(own, pa.large_string())):
            ids, places = coder.encode_all(block)
            assert [ids[a:b].tolist() for a, b in zip(places[:-1], places[1:], strict=True)] == want
    ids, places = coder.encode_all(pa.array([None, ""], pa.string()))
    assert (len(ids), places.tolist()) == (0, [0, 0, 0])


def test_tokenizer_without_marked_word_ends(spec):
    import json

    from tokenizers import Tokenizer

    other = json.loads(spec)
    model = other["model"]
    model["end_of_word_suffix"] = None
    model["merges"] = [m for m in model["merges"] if not m[1].endswith("</w>")]
    tokenizer = Tokenizer.from_str(json.dumps(other))
    coder = P.WordEncoder(json.dumps(other))
    text = "some words of letters, and İ 12 marks !!"
    assert coder._ends is None
    assert memoryview(coder.encode(text.encode())).cast("I").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_query_on_documents(spark, tokenizer):
    from shelfline.llm import queries

    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    pieces = {}
    for r in queries.op12_packing(spark, sf).collect():
        pieces.setdefault(r.doc_id, []).append(r)
    assert set(pieces) == set(docs)
    for d, mine in pieces.items():
        ids = [*tokenizer.encode(docs[d] or "", add_special_tokens=False).ids, 1]
        at = 0
        for p in sorted(mine, key=lambda p: p["start"]):
            part = ids[at: at + p["length"]]
            assert (p["start"], p.doc_tokens) == (at, len(ids))
            assert p.ids_crc32 == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part))
            at += p["length"]
        assert at == len(ids)

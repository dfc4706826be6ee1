"""Base measures against plain Python; the line labeller against its definition."""

import itertools
import re

import numpy as np

from shelfline.llm import quality as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = [
    None, "", "   \n\t ", "one two", "a b c d e f g h i j k", "a b c d e " * 5, "x\nx\n x\nx \n\n\nx", "# * $ % & | < > [",
    "é ü 日本 語", "a\x0bb\x0cc\rd\x85e\u2003f", "same line here\nsame line here\nother", "w " * 4000, "a b c d e f a b c d e g a b c d",
    "\n".join(["row of words that is fine."] * 3), "1 2 3 4 5 6 7 8 9 10 1 2 3 4 5", "日本 " * 30,
]


def brute(text):
    w = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    hit = {i + j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(5)} if len(w) < 1000 else set(range(len(w)))
    base = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit))
    return *base, base[0] < 10 or 100 * base[4] > 20 * base[0]


def test_measures(frame):
    rows = [(i, t, True) for i, t in enumerate(TEXTS)] + [(None, "again again", None)] * 2
    judged = Q.judge(frame(rows, "doc_id long, text string, kept boolean"), Q.LineModel.fallback())
    out = judged.collect()
    assert len(out) == len(rows)
    for r in out:
        assert tuple(r[c] for c in Q.MEASURES) + (r.base_failed,) == brute(r.text), r.text
        assert r.kept is False if r.base_failed else r.kept == (r.content_share >= Q.MIN_CONTENT_SHARE)


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    for r in Q.judge(docs, Q.LineModel.fallback()).collect():
        if len(r.text) < 6000:
            assert tuple(r[c] for c in Q.MEASURES) + (r.base_failed,) == brute(r.text)


def test_viterbi_equals_enumeration():
    rng = np.random.default_rng(2)
    model = Q.LineModel(rng.normal(size=(3, 2)), rng.normal(size=(2, 2)))
    doc = np.repeat(np.arange(5), [1, 4, 2, 6, 3])
    x = rng.normal(size=(len(doc), 3))
    label = Q.viterbi(model, x, doc)
    for d in range(5):
        at = np.flatnonzero(doc == d)
        score = x[at] @ model.unary
        best = max(itertools.product((0, 1), repeat=len(at)),
                   key=lambda y: sum(score[i, k] for i, k in enumerate(y)) + sum(model.transition[a, b] for a, b in itertools.pairwise(y)))
        assert tuple(label[at]) == best


def test_training_separates_and_falls_back(spark):
    prose = "the quick brown fox jumps over the lazy dog and runs far away from here.\n" * 1
    junk = "Th%%% of*** and### the$$$ or%%% and%%% so*** it### is$$$ at%%% no&&&\n"
    rows = [(i, (prose.replace("fox", f"fox{i}") + f"and then line {i} follows on with more words here.") if i % 2 else junk * 2 + f"x{i}%%%")
            for i in range(60)]
    docs = spark.createDataFrame(rows + [(None, None), (70, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(70, 1), (None, 1), (3, None), (3, 1)], "doc_id long, quality int")
    model = Q.fit(docs, labels)
    kept = {r.doc_id: r.kept for r in Q.judge(docs, model).collect()}
    assert all(kept[i] for i in range(1, 60, 2))
    assert not any(kept[i] for i in range(0, 60, 2))
    assert not kept[70]
    same = Q.fit(docs, labels)
    assert np.array_equal(model.unary, same.unary)
    assert np.array_equal(Q.fit(docs, labels.limit(0)).unary, Q.LineModel.fallback().unary)
    assert Q.judge(docs.limit(0), model).count() == 0


def test_held_out_labels(spark):
    """Trained on half of the labelled documents, right on the other half."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality")
    model = Q.fit(docs, labels.filter("doc_id % 2 = 0"))
    rows = Q.judge(docs, model).join(labels.filter("doc_id % 2 = 1"), "doc_id").filter("NOT base_failed").select("quality", "kept").collect()
    right = sum(r.kept == (r.quality == 1) for r in rows) / len(rows)
    assert right >= 0.97


def test_training_rows_are_bounded_where_ids_repeat(spark, monkeypatch):
    """An id on many rows is one document of the sample."""
    seen = []
    monkeypatch.setattr(Q, "train", lambda x, doc, label: seen.append(int(doc.max()) + 1))
    docs = spark.createDataFrame([(i % 2, f"some text of row {i} here.\nand more") for i in range(62)], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(0, 1), (1, 0)], "doc_id long, quality int")
    Q.fit(docs, labels, train_docs=1)
    Q.fit(docs, labels)
    assert seen == [1, 2]

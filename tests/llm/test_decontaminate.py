"""Winnowing against comparing every window."""

import random
import re

import pytest

from shelfline.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, bench):
    windows = {}
    for item, text in bench:
        w = words(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[i:i + 10]), set()).add(str(item) if item is not None else None)
    out = []
    for d, text in docs:
        w, hit, items = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                found = windows.get(tuple(w[i:i + n]))
                if found:
                    hit |= set(range(i, i + n))
                    items |= found
        items.discard(None)
        out.append((d, len(w), len(hit), sorted(items), bool(hit)))
    return sorted(out, key=str)


def corpus():
    rnd = random.Random(11)
    vocab = [f"w{i}" for i in range(40)] + ["Élan", "naïve", "x9", "ß"]
    some = lambda n: [rnd.choice(vocab) for _ in range(n)]
    bench = [(i, " ".join(some(rnd.randint(10, 30)))) for i in range(25)]
    bench += [(30, "short item here"), (31, ""), (32, None), (33, "..."), (None, "w1 w1 w1 w1"), (0, " ".join(some(12))),
              (34, "w2 w2"), (35, " ".join(["w3"] * 15))]
    docs = []
    for i in range(120):
        t = some(rnd.randint(0, 40))
        for _ in range(rnd.randint(0, 2)):
            source = words(rnd.choice(bench)[1])
            a = rnd.randint(0, max(0, len(source) - 5))
            t += source[a:a + rnd.randint(5, 14)] + some(rnd.randint(0, 5))
        docs.append((i if i % 13 else None, rnd.choice([" ", ", ", "-"]).join(t)))
    docs += [(500, None), (501, ""), (502, "SHORT Item, here!"), (503, " ".join(["W3"] * 40)), (504, "...?!")]
    docs += [docs[5], docs[5]]
    return docs, bench


@pytest.mark.parametrize("bound", [D.MAX_BROADCAST, 0])
def test_equals_brute_force(frame, bound):
    docs, bench = corpus()
    found = D.scan(frame([(*d, "x") for d in docs], "doc_id long, text string, n_hit string"),
                   frame(bench, "item_id long, text string"), max_broadcast=bound)
    assert found.columns == ["doc_id", "text", "n_words", "n_hit", "items", "contaminated"]
    rows = sorted(((r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in found.collect()), key=str)
    assert rows == brute(docs, bench)


@pytest.mark.parametrize("bound", [D.MAX_BROADCAST, -1])
def test_empty_tables(spark, bound):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    row = D.scan(docs, none, max_broadcast=bound).first()
    assert (row.n_words, row.n_hit, row["items"], row.contaminated) == (3, 0, [], False)
    assert D.scan(docs.limit(0), none, max_broadcast=bound).count() == 0

"""Hard negatives against scoring all rows in plain Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfline.llm import negatives as N

SCHEMA = "vec_id long, embedding array<float>, label int, rank string, anchor string"


def brute(rows, is_anchor, positives=5, negatives=5, low=80, high=100):
    part = []
    for i, (vec_id, v, label, *_) in enumerate(rows):
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        part.append((i, vec_id, label, [math.floor(256 * float(np.float32(x))) for x in v]))
    key = lambda x: (-x[0], x[1] is None, x[1] or 0)
    out = []
    for i, vec_id, label, v in part:
        if not is_anchor(vec_id):
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), c, lab, j) for j, c, lab, w in part]
        mates = sorted((x for x in scored if x[2] == label and x[3] != i), key=key)[:positives]
        for r, (p, pid, _, _) in enumerate(mates, 1):
            hard = sorted((x for x in scored if x[2] != label and low * p <= 100 * x[0] <= high * p), key=key)[:negatives]
            out += [(vec_id, pid, r, k, x[1], p, x[0]) for k, x in enumerate(hard, 1)]
    return sorted(out, key=str)


def table(n=260, dim=6):
    rnd = random.Random(8)
    centres = [[rnd.gauss(0, 1) for _ in range(dim)] for _ in range(4)]
    rows = []
    for i in range(n):
        c = rnd.choice(centres)
        rows.append((i, [x + rnd.gauss(0, 0.4) for x in c], rnd.randint(0, 3), "r", None))
    twin = [0.5] * dim
    rows += [(i, twin, i % 2, None, "a") for i in range(300, 360)]  # ties, also at anchors
    return rows + [(400, None, 1, "", ""), (410, [1.0] * dim, None, "", ""), (420, [1.0, None, 2.0], 1, "", ""),
                   (430, [float("nan")] * dim, 1, "", ""), (440, [float("inf")] * dim, 1, "", ""), (450, [], 1, "", ""),
                   (460, [0.25], 2, "", ""), (460, [0.25], 2, "", ""), (None, twin, 1, "", ""), (None, [2.0] * dim, 0, "", ""),
                   (470, [1.5] * (dim + 3), 3, "", ""), (480, [0.0] * dim, 9, "", ""), (-10, twin, -3, "", "")]


def got(df, every, **kw):
    return sorted((tuple(r) for r in N.mine(df, F.col("vec_id") % every == 0, **kw).collect()), key=str)


@pytest.mark.parametrize("kw", [{}, {"tree_rows": 3, "chunk_trees": 2}, {"tree_rows": 1}, {"positives": 2, "negatives": 7, "low": 30}])
def test_equals_brute_force(frame, kw):
    rows = table()
    plain = {k: v for k, v in kw.items() if k in ("positives", "negatives", "low")}
    want = brute(rows, lambda i: i is not None and i % 10 == 0, **plain)
    assert len(want) > 500
    assert got(frame(rows, SCHEMA), 10, **kw) == want


def test_large_components_stay_exact(frame):
    rnd = random.Random(2)
    rows = [(i, [float(rnd.randint(-1 << 20, 1 << 20)) for _ in range(3)], i % 3, "", "") for i in range(40)]
    want = brute(rows, lambda i: i % 5 == 0)
    assert any(abs(r[5]) > 1 << 54 for r in want)
    assert got(frame(rows, SCHEMA), 5) == want


def test_nothing_to_find(frame):
    assert got(frame([], SCHEMA), 10) == []
    assert got(frame([(1, [1.0], 1, "", "")], SCHEMA), 10) == []
    assert got(frame([(10, [1.0], 1, "", ""), (20, [1.0], 2, "", "")], SCHEMA), 10) == []
    assert got(frame([(10, [1.0], 1, "", ""), (20, [1.0], 1, "", "")], SCHEMA), 10) == []


def test_tree_spans_and_bounds_save_work():
    rnd = np.random.default_rng(0)
    near = np.floor(rnd.normal(0, 4, (30, 16)) + 200).astype(np.int64)  # anchors close together
    order, parent, edge = N.spanning_tree(near)
    assert sorted(order) == list(range(30))
    seen = set()
    for a in order.tolist():
        assert parent[a] == -1 if not seen else parent[a] in seen
        if seen:
            assert edge[a] == pytest.approx(np.sqrt(((near[a] - near[parent[a]]) ** 2).sum()))
        seen.add(a)
    tree = N.Tree({"rows": list(range(30)), "labels": [0] * 30, "vectors": near.tolist(), "order": order.tolist(),
                   "parent": parent.tolist(), "edge": edge.tolist()})
    cands = np.floor(rnd.normal(0, 60, (500, 16))).astype(np.int64)
    norm = np.sqrt((cands.astype(float) ** 2).sum(axis=1))
    found = {}
    done = tree.visit(cands, norm, lambda a, lo, hi: hi >= 60_000, lambda a, at, s: found.update({a: set(at[s >= 60_000])}))
    want = cands @ near.T
    assert all(found.get(a, set()) == set(np.flatnonzero(want[:, a] >= 60_000)) for a in range(30))
    assert done < 0.5 * want.size


def test_query_equals_sql_and_brute_force(spark):
    import duckdb

    from shelfline.llm import queries

    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    want = con.execute(queries.ORACLE["op11_hard_negatives"]).fetchall()
    assert sorted(map(tuple, queries.op11_hard_negatives(spark, sf).collect())) == sorted(want)
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 and r.label is not None else r.label)
            for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    plain = brute(rows, lambda i: i is not None and i % 100 == 0)
    assert sorted((a, p, k, n, ps, ns) for a, p, _, k, n, ps, ns in plain) == sorted(want)

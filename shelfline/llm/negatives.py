"""Hard negatives for anchors, by bounds along spanning trees of the anchors.

A candidate's score with an anchor is their integer inner product.  Two anchors
at distance d give a candidate c scores that differ by at most d * |c|, so the
score interval at a parent anchor, widened by edge length times candidate norm,
bounds the score at the child.

1. Anchors are sorted by label and coarse direction and cut into trees of at
   most ``TREE_ROWS``: a minimum spanning tree each, parents before children.
2. Every task meets its candidates with the trees, tree by tree from the root.
   The root is scored; at a child only candidates whose bounds overlap the
   child's window are rescored, and the others hand their bounds on.
3. Positives first: the window reaches up from the least score among the
   anchor's best same-label rows so far.  Then negatives: for each positive a
   window from ``low`` to ``high`` percent of its score, which narrows as better
   negatives are found.  Each task hands on a few rows per anchor, which are
   ranked per anchor in a shuffle.

The anchors are a query set that meets all rows: trees are taken in chunks of
at most about ``CHUNK_TREES`` (a few MB, broadcast), one pair of scans a chunk.
Bounds only save work; results are exact and the same for any trees.

Defined cases: rows with a null label, a null vector or a null or non-finite
component take no part; shorter vectors are filled up with zeros, an empty
vector scores 0; each row is a row of its own, also where ids repeat; a null id
comes last among ties; an anchor without positives or a positive without
negatives gives no rows; components are held to the range of a 64-bit integer,
and so are scores; other columns don't matter; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm import store

POSITIVES = 5
NEGATIVES = 5
LOW, HIGH = 80, 100
SCALE = 256
TREE_ROWS = 256
CHUNK_TREES = 16
_EXACT = float(1 << 53)
_LONG = (1 << 63) - 1
_FOUND = "anchor long, row long, id long, score long"


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Integer vectors as rows of one matrix, shorter ones filled up with zeros."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    size = np.diff(vectors.offsets.to_numpy().astype(np.int64))
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(size), int(size.max(initial=0))), dtype=np.int64)
    out[np.arange(out.shape[1]) < size[:, None]] = flat
    return out


def _fill(m: np.ndarray, width: int) -> np.ndarray:
    return m if m.shape[1] == width else np.pad(m, ((0, 0), (0, width - m.shape[1])))


def _score(m: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of ``m`` with ``v`` (floating point only while that is exact)."""
    most = float(np.abs(m.astype(np.float64)).max(initial=0)) * float(np.abs(v.astype(np.float64)).max(initial=0))
    if most * max(m.shape[1], 1) < _EXACT:
        return (m.astype(np.float64) @ v.astype(np.float64)).astype(np.int64)
    exact = m.astype(object) @ v.astype(object)
    return np.array([min(max(int(x), -_LONG - 1), _LONG) for x in exact], dtype=np.int64)


def spanning_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order, parent and edge length of a minimum spanning tree (Prim); the root's parent is -1."""
    n = len(points)
    p = points.astype(np.float64)
    nearest, parent = np.full(n, np.inf), np.full(n, -1)
    left = np.ones(n, dtype=bool)
    order, edge = np.empty(n, np.int64), np.zeros(n)
    at = 0
    for i in range(n):
        order[i], left[at] = at, False
        edge[at] = nearest[at] if i else 0.0
        d = np.sqrt(((p - p[at]) ** 2).sum(axis=1))
        closer = left & (d < nearest)
        nearest[closer], parent[closer] = d[closer], at
        if i + 1 < n:
            at = int(np.flatnonzero(left)[np.argmin(nearest[left])])
    return order, parent, edge


_TREE = "rows array<long>, labels array<long>, vectors array<array<long>>, order array<long>, parent array<long>, edge array<double>"


def _plant(tree_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Trees of consecutive anchors."""
        held: list[pa.RecordBatch] = []
        for batch in batches:
            for at in range(0, batch.num_rows, tree_rows):
                held.append(batch.slice(at, tree_rows))
                while sum(b.num_rows for b in held) >= tree_rows:
                    whole = pa.Table.from_batches(held).combine_chunks()
                    yield _tree(whole.slice(0, tree_rows))
                    held = whole.slice(tree_rows).to_batches()
        if sum(b.num_rows for b in held):
            yield _tree(pa.Table.from_batches(held))
    return run


def _tree(anchors: pa.Table) -> pa.RecordBatch:
    order, parent, edge = spanning_tree(_matrix(anchors["vector"]))
    one = [pa.array([x.to_pylist()], t) for x, t in (
        (anchors["row"], pa.list_(pa.int64())), (anchors["label"], pa.list_(pa.int64())),
        (anchors["vector"], pa.list_(pa.list_(pa.int64()))))]
    return pa.RecordBatch.from_arrays(
        [*one, pa.array([order.tolist()], pa.list_(pa.int64())), pa.array([parent.tolist()], pa.list_(pa.int64())),
         pa.array([edge.tolist()], pa.list_(pa.float64()))], names=["rows", "labels", "vectors", "order", "parent", "edge"])


class Tree:
    """Some anchors with the tree that spans them."""

    def __init__(self, row: dict):
        self.rows, self.labels = np.array(row["rows"]), np.array(row["labels"])
        self.vectors = _matrix(pa.array(row["vectors"], pa.list_(pa.int64())))
        self.order, self.parent, self.edge = row["order"], row["parent"], row["edge"]

    def visit(self, m: np.ndarray, norm: np.ndarray, wanted: Callable, use: Callable) -> int:
        """Score candidates at every anchor where ``wanted(anchor, lo, hi)`` says so.

        ``use(anchor, which, scores)`` gets them.  Returns how many scores were
        worked out.
        """
        width = max(m.shape[1], self.vectors.shape[1])
        m, vectors = _fill(m, width), _fill(self.vectors, width)
        lo, hi = {}, {}
        waiting = np.bincount([p for p in self.parent if p >= 0], minlength=len(self.parent))
        done = 0
        for a in self.order:
            p = self.parent[a]
            if p < 0:
                at = np.arange(len(m))
                low, high = np.empty(len(m)), np.empty(len(m))
            else:
                # A little more than the exact bound, for the rounding of floating point.
                reach = self.edge[a] * norm * (1 + 1e-9)
                low, high = lo[p] - reach, hi[p] + reach
                low -= np.abs(low) * 1e-12 + 1e-6
                high += np.abs(high) * 1e-12 + 1e-6
                at = np.flatnonzero(wanted(a, low, high))
            if len(at):
                s = _score(m[at], vectors[a])
                done += len(at)
                low[at] = high[at] = s
                if p < 0:
                    pick = wanted(a, low, high)
                    at, s = at[pick], s[pick]
                use(a, at, s)
            if waiting[a]:
                lo[a], hi[a] = low, high
            if p >= 0:
                waiting[p] -= 1
                if not waiting[p]:
                    del lo[p], hi[p]
        return done


class _Best:
    """The best few (score, id, row) so far: higher scores, then smaller ids, null ids last."""

    def __init__(self, size: int):
        self.size = size
        self.score = self.id = self.row = np.empty(0, np.int64)
        self.null = np.empty(0, bool)

    @property
    def least(self) -> float:
        """Scores below this one can't enter any more."""
        return float(self.score[-1]) if len(self.score) == self.size else -np.inf

    def add(self, score: np.ndarray, ids: np.ndarray, null: np.ndarray, row: np.ndarray) -> None:
        score, ids = np.concatenate([self.score, score]), np.concatenate([self.id, ids])
        null, row = np.concatenate([self.null, null]), np.concatenate([self.row, row])
        # ~score is monotone decreasing and has no overflow, unlike -score.
        order = np.lexsort((ids, null, ~score))[: self.size]
        self.score, self.id, self.null, self.row = score[order], ids[order], null[order], row[order]


class _Candidates:
    def __init__(self, batch: pa.RecordBatch):
        self.row = batch.column(0).to_numpy()
        self.null = batch.column(1).is_null().to_numpy(zero_copy_only=False)
        self.id = batch.column(1).fill_null(0).to_numpy()
        self.label = batch.column(2).to_numpy()
        self.matrix = _matrix(batch.column(3))
        self.norm = np.sqrt((self.matrix.astype(np.float64) ** 2).sum(axis=1))


def _rows(anchor: int, score: np.ndarray, ids: np.ndarray, null: np.ndarray, row: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(row), anchor, np.int64)), pa.array(row), pa.array(ids, mask=null), pa.array(score)],
        names=["anchor", "row", "id", "score"])


def _positives(shared, few: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each anchor's best same-label rows among this task's candidates."""
        trees = [Tree(r) for r in shared.value]
        best = [[_Best(few) for _ in t.rows] for t in trees]
        for c in map(_Candidates, batches):
            for tree, tops in zip(trees, best, strict=True):
                here = np.isin(c.label, tree.labels)

                def wanted(a, _, high, tree=tree, tops=tops, c=c, here=here):
                    return (c.label[here] == tree.labels[a]) & (c.row[here] != tree.rows[a]) & (high >= tops[a].least)

                def use(a, at, s, tops=tops, c=c, here=np.flatnonzero(here)):
                    at = here[at]
                    tops[a].add(s, c.id[at], c.null[at], c.row[at])

                tree.visit(c.matrix[here], c.norm[here], wanted, use)
        for tree, tops in zip(trees, best, strict=True):
            for a, b in zip(tree.rows, tops, strict=True):
                if len(b.row):
                    yield _rows(a, b.score, b.id, b.null, b.row)
    return run


def _negatives(shared, few: int, low: int, high: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each anchor's best other-label rows under any of its positives, among this task's candidates."""
        rows, positive = shared.value
        trees = [Tree(r) for r in rows]
        # Per anchor: (least, greatest score, best so far) of every positive.
        windows = [[[(-(-low * s // 100), high * s // 100, _Best(few)) for s in positive.get(a, ())] for a in t.rows.tolist()]
                   for t in trees]
        for c in map(_Candidates, batches):
            for tree, win in zip(trees, windows, strict=True):
                def wanted(a, lo, hi, tree=tree, win=win, c=c):
                    ok = np.zeros(len(lo), dtype=bool)
                    for least, most, best in win[a]:
                        ok |= (lo <= most) & (hi >= max(least, best.least))
                    return ok & (c.label != tree.labels[a])

                def use(a, at, s, win=win, c=c):
                    for least, most, best in win[a]:
                        ok = (s >= least) & (s <= most)
                        if ok.any():
                            i = at[ok]
                            best.add(s[ok], c.id[i], c.null[i], c.row[i])

                tree.visit(c.matrix, c.norm, wanted, use)
        for tree, win in zip(trees, windows, strict=True):
            for a, ws in zip(tree.rows, win, strict=True):
                if ws:
                    row = np.concatenate([b.row for _, _, b in ws])
                    _, one = np.unique(row, return_index=True)
                    yield _rows(a, *(np.concatenate([getattr(b, n) for _, _, b in ws])[one] for n in ("score", "id", "null", "row")))
    return run


def prepare(rows: DataFrame, anchor: Column, vec_id: str, label: str, vector: str, scale: int) -> DataFrame:
    """(row, id, label, vector, anchor) of the rows that take part, components as floor(scale * x)."""
    x = F.col(vector).cast("array<double>")
    whole = F.transform(x, lambda v: F.floor(v * F.lit(scale).cast("double")).cast("long"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    part = rows.select(F.col(vec_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), whole.alias("vector"),
                       F.coalesce(anchor, F.lit(False)).alias("anchor"), bad.alias("bad"))
    return part.filter(F.col("label").isNotNull() & F.col("vector").isNotNull() & ~F.col("bad")).drop("bad")


def forest(keyed: DataFrame, tree_rows: int = TREE_ROWS, chunk_trees: int = CHUNK_TREES) -> DataFrame:
    """The anchors' trees, with a chunk number; neighbours in label and coarse direction share a tree."""
    anchors = keyed.filter("anchor")
    parts = max(1, -(-anchors.count() // (tree_rows * chunk_trees)))
    side = F.array_join(F.transform(F.slice("vector", 1, 12), lambda v: F.when(v > 0, "1").otherwise("0")), "")
    dealt = anchors.select("row", "label", "vector", side.alias("side")).repartitionByRange(parts, "label", "side", "row")
    trees = dealt.sortWithinPartitions("label", "side", "row").select("row", "label", "vector").mapInArrow(_plant(tree_rows), _TREE)
    return store.materialise(trees.withColumn("chunk", F.pmod(F.xxhash64(F.col("rows")[0]), F.lit(parts))))


def mine(rows: DataFrame, anchor: Column, vec_id: str = "vec_id", label: str = "label", vector: str = "embedding",
         positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE,
         tree_rows: int = TREE_ROWS, chunk_trees: int = CHUNK_TREES) -> DataFrame:
    """anchor_id, positive_id, positive_rank, rank, negative_id, positive_score, negative_score.

    ``anchor`` tells the anchor rows.  An anchor's positives are its first
    ``positives`` other rows of the same label by score; for each of them the
    first ``negatives`` rows of other labels with low % to high % of its score.
    Percentages are 0 or more; a window that is empty gives no rows.
    """
    spark = rows.sparkSession
    store.prepare(spark)
    keyed = store.with_row_key(prepare(rows, anchor, vec_id, label, vector, scale), "row")
    cands = keyed.select("row", "id", "label", "vector")
    trees = forest(keyed, tree_rows, chunk_trees)
    first = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    out = []
    for (chunk,) in sorted(trees.select("chunk").distinct().collect()):  # bounded broadcasts, one pair of scans each
        some = trees.filter(F.col("chunk") == chunk).drop("chunk").toArrow().to_pylist()
        shared = spark.sparkContext.broadcast(some)
        near = cands.mapInArrow(_positives(shared, positives), _FOUND)
        ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("anchor").orderBy(*first)))
        mates = store.materialise(ranked.filter(F.col("rank") <= positives).select(
            "anchor", F.col("id").alias("positive_id"), F.col("rank").alias("positive_rank"), F.col("score").alias("positive_score")))
        limits: dict[int, list[int]] = {}
        for a, s in mates.select("anchor", "positive_score").toArrow().to_pandas().itertuples(index=False):
            limits.setdefault(int(a), []).append(int(s))
        window = spark.sparkContext.broadcast((some, limits))
        other = cands.mapInArrow(_negatives(window, negatives, low, high), _FOUND)
        wide = lambda c, n: F.col(c).cast("decimal(20,0)") * F.lit(n)
        both = other.join(mates, "anchor").filter(
            (wide("positive_score", low) <= wide("score", 100)) & (wide("score", 100) <= wide("positive_score", high)))
        place = F.row_number().over(Window.partitionBy("anchor", "positive_rank").orderBy(*first))
        out.append(store.materialise(both.withColumn("rank", place).filter(F.col("rank") <= negatives).select(
            "anchor", "positive_id", "positive_rank", "rank", F.col("id").alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score"))))
        shared.destroy()
        window.destroy()
    names = keyed.filter("anchor").select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    if not out:
        out = [spark.createDataFrame([], "anchor long, positive_id long, positive_rank int, rank int, negative_id long, "
                                         "positive_score long, negative_score long")]
    found = out[0]
    for more in out[1:]:
        found = found.union(more)
    return found.join(names, "anchor").select(
        "anchor_id", "positive_id", "positive_rank", "rank", "negative_id", "positive_score", "negative_score")

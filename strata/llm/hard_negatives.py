"""Hard-negative mining over exact integer scores, tile by tile.

Anchors are dealt into blocks and all rows into slots, both of bounded size;
every (block, slot) cell is one group whose tiles of scores come from
Strassen's recursive multiplication on 64-bit integers, zero-padded to even
sizes.  Integer additions wrap, so intermediate sums cannot spoil a result
that fits.  A cell returns the best few of each anchor, and the best few of
all cells are merged: first the positives, then, with the window of negative
scores that each positive opens, the negatives inside it.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import staged
from strata.llm.vector_codes import LONG, scaled

LEAF = 32  # a matrix with no side above this is multiplied plainly
BLOCK = 8192  # anchors of a block
SLOT = 32768  # rows of a slot
TILE_ANCHORS, TILE_ROWS = 512, 4096  # a tile of scores: 16 MB
SCALE = 256


def _even(a: np.ndarray) -> np.ndarray:
    """``a`` with a row and a column of zeros added where its sizes are odd."""
    return np.pad(a, ((0, a.shape[0] % 2), (0, a.shape[1] % 2))) if a.shape[0] % 2 or a.shape[1] % 2 else a


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b`` with seven products of halves instead of eight, recursively down to ``leaf``."""
    if min(a.shape[0], a.shape[1], b.shape[1]) <= leaf:
        return a @ b
    rows, cols = a.shape[0], b.shape[1]
    a, b = _even(a), _even(b)
    i, k, j = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :k], a[:i, k:], a[i:, :k], a[i:, k:]
    b11, b12, b21, b22 = b[:k, :j], b[:k, j:], b[k:, :j], b[k:, j:]
    out = np.empty((2 * i, 2 * j), a.dtype)
    upper, right, lower, left = out[:i, :j], out[:i, j:], out[i:, :j], out[i:, j:]
    p = strassen(a11 + a22, b11 + b22, leaf)
    upper[:] = p
    left[:] = p
    p = strassen(a21 + a22, b11, leaf)
    lower[:] = p
    left -= p
    p = strassen(a11, b12 - b22, leaf)
    right[:] = p
    left += p
    p = strassen(a22, b21 - b11, leaf)
    upper += p
    lower += p
    p = strassen(a11 + a12, b22, leaf)
    upper -= p
    right += p
    left += strassen(a21 - a11, b11 + b12, leaf)
    upper += strassen(a12 - a22, b21 + b22, leaf)
    return out[:rows, :cols]


def scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products (anchor, row): exact, in Python integers where a long could overflow."""
    top = [max(abs(int(m.max())), abs(int(m.min()))) if m.size else 0 for m in (anchors, rows)]
    if top[0] * top[1] * max(1, anchors.shape[1]) > LONG:
        anchors, rows = anchors.astype(object), rows.astype(object)
    return strassen(anchors, rows.T)


def _long(x) -> int:
    """A score as it is returned: beyond a long, its end."""
    return max(-LONG - 1, min(LONG, int(x)))


def _matrix(col: pa.ChunkedArray, at: np.ndarray) -> np.ndarray:
    part = col.take(pa.array(at)).combine_chunks()
    return part.flatten().to_numpy(zero_copy_only=False).reshape(len(at), -1)


def _tiles(table: pa.Table) -> Iterator[tuple]:
    """(anchor rows, candidate rows, scores) of a cell, tile by tile; candidates by ascending id.

    Only vectors of equal length meet.
    """
    role = table.column("anchor").to_numpy()
    ids = table.column("vec_id").to_numpy()
    size = pc.list_value_length(table.column("q")).to_numpy()
    for dim in np.unique(size[role]):
        of, rows = np.flatnonzero(role & (size == dim)), np.flatnonzero(~role & (size == dim))
        rows = rows[np.argsort(ids[rows], kind="stable")]
        for lo in range(0, len(rows), TILE_ROWS):
            own = rows[lo:lo + TILE_ROWS]
            x = _matrix(table.column("q"), own)
            for at in range(0, len(of), TILE_ANCHORS):
                part = of[at:at + TILE_ANCHORS]
                yield part, own, scores(_matrix(table.column("q"), part), x)


def _labels(table: pa.Table) -> np.ndarray:
    """Labels as small integers, equal where the labels are."""
    return table.column("label").combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)


class Heaps:
    """The best ``k`` (highest score, then smallest id) of every owner, from any number of tiles."""

    def __init__(self, k: int):
        self.k, self.best = k, {}

    def put(self, owner, found: np.ndarray, ids: np.ndarray) -> None:
        """``found`` scores by descending score, ``ids`` beside them."""
        new = [(-int(s), int(i)) for s, i in zip(found[:self.k], ids[:self.k])]
        self.best[owner] = sorted(self.best.get(owner, []) + new)[:self.k]

    def rows(self) -> Iterator[tuple]:
        for owner, best in self.best.items():
            for s, i in best:
                yield owner, i, _long(-s)


def _best_first(s: np.ndarray) -> np.ndarray:
    return np.argsort(-s, kind="stable")  # candidates ascend by id, so ties do too


def _cell_positives(table: pa.Table, k: int) -> pa.Table:
    ids, label, heaps = table.column("vec_id").to_numpy(), _labels(table), Heaps(k)
    for of, own, s in _tiles(table):
        for name in np.unique(label[of]):
            cols = np.flatnonzero(label[own] == name)
            for a in np.flatnonzero(label[of] == name):
                use = cols[ids[own[cols]] != ids[of[a]]]
                if len(use):
                    row = s[a, use]
                    top = _best_first(row)[:k]
                    heaps.put(int(ids[of[a]]), row[top], ids[own[use[top]]])
    out = list(heaps.rows())
    return pa.table({"anchor_id": pa.array([x[0] for x in out], pa.int64()), "vec_id": pa.array([x[1] for x in out], pa.int64()),
                     "score": pa.array([x[2] for x in out], pa.int64())})


def _cell_negatives(table: pa.Table, k: int, low: int, high: int) -> pa.Table:
    ids, label, heaps = table.column("vec_id").to_numpy(), _labels(table), Heaps(k)
    for of, own, s in _tiles(table):
        for a, at in enumerate(of):
            windows = [(p["vec_id"], p["score"], -(-low * p["score"] // 100), high * p["score"] // 100)
                       for p in table.column("positives")[int(at)].as_py()]
            windows = [w for w in windows if w[2] <= w[3]]
            if not windows:
                continue
            least, most = min(w[2] for w in windows), max(w[3] for w in windows)
            use = np.flatnonzero((s[a] >= least) & (s[a] <= most) & (label[own] != label[at]))
            use = use[_best_first(s[a, use])]
            row = s[a, use]
            for pid, score, lo, hi in windows:
                inside = np.flatnonzero((row <= hi) & (row >= lo))[:k]
                if len(inside):
                    heaps.put((int(ids[at]), pid, score), row[inside], ids[own[use[inside]]])
    out = list(heaps.rows())
    names = ("anchor_id", "positive_id", "positive_score")
    cols = {n: pa.array([x[0][i] for x in out], pa.int64()) for i, n in enumerate(names)}
    return pa.table(cols | {"negative_id": pa.array([x[1] for x in out], pa.int64()),
                            "negative_score": pa.array([x[2] for x in out], pa.int64())})


def _cells(anchors: DataFrame, rows: DataFrame, blocks: int, slots: int, run: Callable, schema: str) -> DataFrame:
    """``run`` on every cell of a block of anchors and a slot of rows."""
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    of = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    a = anchors.select("vec_id", "label", "q", "positives", F.lit(True).alias("anchor"), of(blocks).alias("block"), every(slots).alias("slot"))
    r = rows.select("vec_id", "label", "q", F.lit(None).cast(anchors.schema["positives"].dataType).alias("positives"),
                    F.lit(False).alias("anchor"), every(blocks).alias("block"), of(slots).alias("slot"))
    return a.unionByName(r).groupBy("block", "slot").applyInArrow(run, schema)


def prepared(df: DataFrame, key: str = "vec_id", vec: str = "embedding", label: str = "label", scale: int = SCALE) -> DataFrame:
    """(vec_id, label, q): one row per id, the smallest vector (then label) where an id repeats.

    NULL ids and labels, NULL or empty vectors and those with NULL or
    non-finite components are left out.  Components beyond a long after
    scaling count as its ends.
    """
    d = df.select(F.col(key).cast("bigint").alias("vec_id"), F.col(label).alias("label"), scaled(F.col(vec), scale).alias("q"))
    d = d.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("q").isNotNull() & (F.size("q") > 0))
    one = d.groupBy("vec_id").agg(F.min(F.struct("q", "label")).alias("m"))
    return one.select("vec_id", F.col("m.label").alias("label"), F.col("m.q").alias("q"))


def mine(anchors: DataFrame, rows: DataFrame, n_positives: int = 5, n_negatives: int = 3, low: int = 50, high: int = 95,
         block: int = BLOCK, slot: int = SLOT) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Both inputs come from :func:`prepared`.  An anchor's positives are its
    ``n_positives`` best other rows of its label; for each of them the
    ``n_negatives`` best rows of other labels whose score is between ``low``
    and ``high`` per cent of the positive's.  Higher scores first, ties to
    the smaller id.  Anchors without a positive, and positives without a
    negative in their window (all whose score is below zero), give no row.
    Vectors of unequal length never meet.  Scores are exact; a score beyond a
    long counts as its end, in the results and in the windows.  Empty inputs give an empty result.
    """
    rows = staged(rows.select("vec_id", "label", "q"), "negative-rows")
    kind = "array<struct<vec_id:bigint,score:bigint>>"
    anchors = staged(anchors.select("vec_id", "label", "q", F.lit(None).cast(kind).alias("positives")), "negative-anchors")
    spread = rows.sparkSession.sparkContext.defaultParallelism
    blocks = max(1, math.ceil(anchors.count() / block))
    slots = max(math.ceil(rows.count() / slot), math.ceil(spread / blocks))
    near = _cells(anchors, rows, blocks, slots, lambda t: _cell_positives(t, n_positives),
                  "anchor_id bigint, vec_id bigint, score bigint")
    w = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    near = near.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n_positives)
    mine_ = staged(near.groupBy("anchor_id").agg(F.collect_list(F.struct("vec_id", "score")).alias("positives")), "negative-positives")
    asking = anchors.drop("positives").join(mine_.withColumnRenamed("anchor_id", "vec_id"), "vec_id")
    far = _cells(asking, rows, blocks, slots, lambda t: _cell_negatives(t, n_negatives, low, high),
                 "anchor_id bigint, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint")
    w = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return far.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n_negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")

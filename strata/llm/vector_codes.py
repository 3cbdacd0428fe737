"""Vector code compression: product codes whose entries are found through LAESA pivots.

Vectors become integers and are cut into consecutive parts; every part
position has a small codebook, refined in rounds of assignment and averaging.
Distances of a part to a few fixed pivots are computed once and stored with
it.  In a round the distances from those pivots to the current entries give a
lower bound for every part-entry distance (the triangle inequality: the
largest difference of the two); entries are tried in the order of their
bounds, and those whose bound exceeds the best distance so far are never
evaluated.  What is evaluated is exact integer arithmetic.

The driver holds the codebooks only (entries times dimensions).  A task
returns one sum per entry and component; sums meet in a grouped aggregate.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import staged

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
PIVOTS = 4  # fixed pivots of a part position
SLACK = 1e-12  # relative: a bound must exceed the best distance by more than rounding can make
LONG = 2**63 - 1


def scaled(vec: Column, scale: int) -> Column:
    """floor(scale * x) of every component (at most the ends of a long); NULL for a vector that takes no part."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    q = F.transform(vec, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("bigint"))
    return F.when(vec.isNotNull() & ~F.coalesce(bad, F.lit(True)), q)


def exact(*arrays: np.ndarray) -> list[np.ndarray]:
    """The arrays as they are where squared distances of their rows fit a long, else as Python integers."""
    top = max((max(abs(int(a.max())), abs(int(a.min()))) for a in arrays if a.size), default=0)
    width = arrays[0].shape[-1]
    return list(arrays) if 4 * top * top * max(width, 1) < 2**62 else [a.astype(object) for a in arrays]


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    d = x - y
    return (d * d).sum(-1)


def distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Distances (rows of ``x``, rows of ``points``) in double precision, from exact squares."""
    a, b = exact(x, points)
    return np.stack([np.sqrt(squared(a, p).astype(np.float64)) for p in b], 1)


def pick_pivots(entries: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """``n`` of the entries, each the farthest from those picked before (the first entry first)."""
    far = distances(entries, entries)
    at = [0]
    while len(at) < min(n, len(entries)):
        gap = far[:, at].min(1)
        at.append(int(gap.argmax()))
    return entries[at]


def nearest(x: np.ndarray, to_pivots: np.ndarray, entries: np.ndarray, pivots: np.ndarray) -> tuple:
    """(entry, squared distance, distances evaluated): nearest entry of each row, ties to the lower index."""
    to_entries = distances(pivots, entries)
    bound = np.zeros((len(x), len(entries)))
    for p in range(len(pivots)):
        a, b = to_pivots[:, p, None], to_entries[p]
        np.maximum(bound, np.abs(a - b) - SLACK * (a + b), out=bound)
    order = np.argsort(bound, 1, kind="stable")
    x, entries = exact(x, entries)
    code = order[:, 0].copy()
    best = squared(x, entries[code])
    live, done = np.arange(len(x)), len(x)
    for r in range(1, len(entries)):
        at = order[live, r]
        low = bound[live, at]
        live = live[low * low * (1 - SLACK) <= best[live].astype(np.float64)]  # bounds rise and the best falls: out is out
        if not len(live):
            break
        at = order[live, r]
        d = squared(x[live], entries[at])
        done += len(live)
        won = (d < best[live]) | ((d == best[live]) & (at < code[live]))
        best[live[won]], code[live[won]] = d[won], at[won]
    return code, best, done


def _parts(col: pa.ListArray, parts: int) -> np.ndarray:
    """(rows, parts, components of a part)."""
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), parts, -1)


def _stored(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """The rows with the distances of every part to its pivots, written once."""
    parts, n = pivots.shape[:2]
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = _parts(b.column(2), parts)
            d = np.concatenate([distances(x[:, p], pivots[p]) for p in range(parts)], 1)
            flat = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * parts * n, pa.array(d.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*b.columns, flat], ["vec_id", "label", "q", "to_pivots"])

    schema = f"vec_id {kinds['vec_id']}, label {kinds['label']}, q array<bigint>, to_pivots array<double>"
    return staged(rows.select("vec_id", "label", "q").mapInArrow(run, schema), "vector-parts")


def _coded(b: pa.RecordBatch, books: np.ndarray, pivots: np.ndarray) -> Iterator[tuple]:
    """(part, its components, entries, squared distances) of one batch."""
    parts = len(books)
    x, far = _parts(b.column(2), parts), _parts(b.column(3), parts)
    for p in range(parts):
        code, d, _ = nearest(x[:, p], far[:, p], books[p], pivots[p])
        yield p, x[:, p], code, d


def _averages(rows: DataFrame, books: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The next codebooks: per entry the rounded-down mean of its parts; an unused entry stays."""
    parts, n, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, n, width + 1), object)  # the last column counts
        for b in batches:
            if not b.num_rows:
                continue
            for p, x, code, _ in _coded(b, books, pivots):
                x, = exact(x)
                for e in np.unique(code):
                    own = x[code == e]
                    total[p, e, :width] += own.sum(0)
                    total[p, e, width] += len(own)
        at = np.argwhere(total[:, :, width] > 0)
        if len(at):
            flat = [int(v) for p, e in at for v in total[p, e]]
            where = np.repeat(at, width + 1, 0).astype(np.int32)
            pos = np.tile(np.arange(width + 1, dtype=np.int32), len(at))
            yield pa.RecordBatch.from_arrays(
                [pa.array(where[:, 0]), pa.array(where[:, 1]), pa.array(pos), pa.array(flat, pa.decimal128(38))],
                ["part", "entry", "pos", "total"])

    sums = rows.mapInArrow(run, "part int, entry int, pos int, total decimal(38,0)").groupBy("part", "entry", "pos").agg(
        F.sum("total").alias("total"))
    out = books.astype(object)
    found = {(r.part, r.entry, r.pos): int(r.total) for r in sums.collect()}  # entries times components
    for (p, e, pos), v in found.items():
        if pos < width:
            out[p, e, pos] = v // found[p, e, width]
    return out.astype(np.int64)


def fit(rows: DataFrame, books: np.ndarray, pivots: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    for _ in range(rounds):
        books = _averages(rows, books, pivots)
    return books


def digest(books: np.ndarray) -> str:
    """sha256 of all components by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def assign(rows: DataFrame, books: np.ndarray, pivots: np.ndarray) -> DataFrame:
    """vec_id, label, code (two hex digits a part) and error (squared distances summed; at most the end of a long)."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            codes, error = [], np.zeros(b.num_rows, object)
            for _, _, code, d in _coded(b, books, pivots):
                codes.append(code)
                error = error + d.astype(object)
            text = np.stack(codes, 1).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([r.tobytes().hex() for r in text], pa.string()),
                 pa.array([min(int(e), LONG) for e in error], pa.int64())], ["vec_id", "label", "code", "error"])

    return rows.mapInArrow(run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error bigint")


def compress(df: DataFrame, key: str = "vec_id", vec: str = "embedding", label: str = "label", parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """One row per kept vector: vec_id, code, error, label_error, codebooks_sha256.

    Dropped: NULL or empty vectors, those with NULL or non-finite components,
    and those whose length is not that of the smallest kept id whose length
    ``parts`` divides.  Components beyond a long after scaling count as its
    ends; distances stay exact at any size, and sums beyond a long are given
    as its end.  Rows that repeat an id are all coded; the codebooks start
    with one row per id (the smallest vector).  A NULL id is coded and starts
    nothing; a NULL label is a label of its own.  Fewer ids than ``entries``
    give smaller codebooks; without an id the result is empty.  Other columns
    are ignored.
    """
    d = df.select(F.col(key).alias("vec_id"), F.col(label).alias("label"), scaled(F.col(vec), scale).alias("q"))
    usable = staged(d.filter(F.col("q").isNotNull() & (F.size("q") > 0) & (F.size("q") % parts == 0)), "vector-scaled")
    named = usable.filter(F.col("vec_id").isNotNull())
    first = named.agg(F.min(F.struct("vec_id", F.size("q").alias("n"))).alias("m")).first()["m"]
    kinds = {f.name: f.dataType.simpleString() for f in usable.schema}
    if first is None:
        return df.sparkSession.createDataFrame(
            [], f"vec_id {kinds['vec_id']}, code string, error bigint, label_error bigint, codebooks_sha256 string")
    kept = usable.filter(F.size("q") == first["n"])
    ids = [r[0] for r in kept.filter(F.col("vec_id").isNotNull()).select("vec_id").distinct().orderBy("vec_id").limit(entries).collect()]
    start = kept.filter(F.col("vec_id").isin(ids)).groupBy("vec_id").agg(F.min("q").alias("q")).orderBy("vec_id").collect()
    books = np.array([r["q"] for r in start], np.int64).reshape(len(start), parts, -1).transpose(1, 0, 2)
    pivots = np.stack([pick_pivots(b) for b in books])
    rows = _stored(kept, pivots)
    books = fit(rows, books, pivots, rounds)
    coded = staged(assign(rows, books, pivots), "vector-codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG).cast("decimal(38,0)")).cast("bigint")
    sums = coded.groupBy(F.col("label").alias("of")).agg(total.alias("label_error"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of")), "left").select(
        "vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def evaluated_share(x: np.ndarray, entries: np.ndarray) -> float:
    """Share of part-entry distances that the bounds leave to be evaluated, for one part position."""
    pivots = pick_pivots(entries)
    return nearest(x, distances(x, pivots), entries, pivots)[2] / max(1, math.prod((len(x), len(entries))))

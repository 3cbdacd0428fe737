"""Exact top-k search by distributed histogram selection.

Every query is scored against every vector.  Rounds of score histograms,
summed over all tasks, narrow the interval that holds each query's k-th best
score until it is one value; rows above it, and the smallest ids at it, are
the answer.  Queries are taken in blocks of bounded size, so the driver and
each task hold one block of queries and never all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import staged

BLOCK_QUERIES = 4096  # queries scored together: with 64 components 2 MB
ROWS = 2048  # candidates scored at once
BINS = 256  # intervals of a histogram round
EXACT = 2**50  # scores and bins below this are exact in double precision; beyond, scores are Python integers
LONG = 2**63 - 1


def quantised(vec: Column) -> Column:
    """floor(256 * x) of each component; NULL for vectors that take no part."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    q = F.transform(vec, lambda x: F.floor(x.cast("double") * F.lit(256.0)).cast("double"))
    return F.when(vec.isNotNull() & ~F.coalesce(bad, F.lit(True)), q)


def vectors(df: DataFrame, key: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """(vec_id, q) of all vectors that take part: one per id, the smallest vector where an id repeats."""
    d = df.select(F.col(key).cast("bigint").alias("vec_id"), F.col(vec).alias("v")).filter(F.col("vec_id").isNotNull())
    d = d.select("vec_id", quantised(F.col("v")).alias("q")).filter(F.col("q").isNotNull() & (F.size("q") > 0))
    return d.groupBy("vec_id").agg(F.min("q").alias("q"))


def _numbers(rows: list, whole: bool) -> np.ndarray:
    """A matrix of doubles, or of Python integers."""
    x = np.array(rows, np.float64)
    return np.vectorize(int, otypes=[object])(x) if whole else x


def _scores(batches: Iterator[pa.RecordBatch], ids: np.ndarray, q: np.ndarray, below: np.ndarray) -> Iterator[tuple]:
    """(candidate ids, scores[query, candidate]) block by block; a query's own row scores ``below`` everything."""
    for b in batches:
        for lo in range(0, b.num_rows, ROWS):
            part = b.slice(lo, ROWS)
            if not part.num_rows:
                continue
            own = part.column(0).to_numpy()
            x = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(own), q.shape[1])
            s = q @ _numbers(x, q.dtype == object).T
            yield own, np.where(ids[:, None] == own[None, :], below[:, None], s)


def _as(q: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whole numbers in the arithmetic of the scores."""
    return values if q.dtype == object else values.astype(np.float64)


def _histogram(cand: DataFrame, ids: np.ndarray, q: np.ndarray, low: np.ndarray, width: np.ndarray, k: int) -> DataFrame:
    """Counts of scores by (query, bin) over all candidates; bin 0 starts at ``low``, the last is open above.

    A task reports its bins from the top down until they hold k of its own
    scores: the global k-th best is never below a task's own k-th best.
    """
    low, width, below = _as(q, low), _as(q, width), _as(q, low - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(ids), BINS), np.int64)
        base = np.arange(len(ids))[:, None] * BINS
        for _, s in _scores(batches, ids, q, below):
            at = (s - low[:, None]) // width[:, None] if s.dtype == object else np.floor((s - low[:, None]) / width[:, None])
            use = (at >= 0).astype(bool)
            flat = (np.minimum(at, BINS - 1) + base)[use].astype(np.int64)
            total += np.bincount(flat, minlength=total.size).reshape(total.shape)
        above = total[:, ::-1].cumsum(1)[:, ::-1] - total
        row, bin_ = np.nonzero((total > 0) & (above < k))
        if len(row):
            yield pa.RecordBatch.from_arrays(
                [pa.array(row, pa.int32()), pa.array(bin_, pa.int32()), pa.array(total[row, bin_], pa.int64())],
                ["qi", "bin", "n"])

    return cand.mapInArrow(run, "qi int, bin int, n bigint").groupBy("qi", "bin").agg(F.sum("n").alias("n"))


def _kth_scores(cand: DataFrame, ids: np.ndarray, q: np.ndarray, bound: np.ndarray, k: int) -> np.ndarray:
    """The k-th best score of each query (its smallest score if it has fewer than k candidates), as Python integers."""
    low, high = -bound - 1, bound + 1  # the k-th lies in [low, high]
    while True:
        width = np.maximum(1, -(-(high - low + 1) // BINS))
        pdf = _histogram(cand, ids, q, low, width, k).toPandas()  # at most a block's queries times BINS rows
        total = np.zeros((len(ids), BINS), np.int64)
        total[pdf["qi"].to_numpy(), pdf["bin"].to_numpy()] = pdf["n"].to_numpy()
        reach = total[:, ::-1].cumsum(1)[:, ::-1] >= k
        # the highest bin from which k scores are reached; too few candidates: the lowest value of the range
        bin_ = np.where(reach.any(1), BINS - 1 - reach[:, ::-1].argmax(1), 0).astype(object)
        if (width == 1).all():
            return low + bin_
        low, high = low + bin_ * width, np.minimum(high, low + (bin_ + 1) * width - 1)


def _select(cand: DataFrame, ids: np.ndarray, q: np.ndarray, bound: np.ndarray, kth: np.ndarray, k: int) -> DataFrame:
    """Rows above each query's k-th score and, per task, its k smallest ids at that score."""
    kth, below = _as(q, kth), _as(q, -bound - 2)

    def make(qi: np.ndarray, v: np.ndarray, s: np.ndarray, above: bool) -> pa.RecordBatch:
        score = [max(-LONG - 1, min(LONG, int(x))) for x in s] if s.dtype == object else s.astype(np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[qi], pa.int64()), pa.array(v, pa.int64()), pa.array(score, pa.int64()), pa.array([above] * len(v))],
            ["query_id", "vec_id", "score", "above"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ties: list[np.ndarray] = [np.empty(0, np.int64) for _ in ids]
        for own, s in _scores(batches, ids, q, below):
            row, col = np.nonzero(s > kth[:, None])
            if len(row):
                yield make(row, own[col], s[row, col], True)
            row, col = np.nonzero(s == kth[:, None])
            if len(row):
                cut = np.flatnonzero(np.diff(row)) + 1
                for r, c in zip(row[np.r_[0, cut]], np.split(col, cut)):
                    ties[r] = np.sort(np.concatenate([ties[r], own[c]]))[:k]
        n = np.array([len(t) for t in ties])
        if n.sum():
            row = np.repeat(np.arange(len(ids)), n)
            yield make(row, np.concatenate(ties), kth[row], False)

    return cand.mapInArrow(run, "query_id bigint, vec_id bigint, score bigint, above boolean")


def topk(queries: DataFrame, candidates: DataFrame, k: int = 5, block: int = BLOCK_QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best integer inner products, ties to the smaller id.

    Both inputs come from :func:`vectors`.  A query's own id is no candidate;
    with fewer than k candidates all are returned; no query or no candidate
    gives an empty result.  Vectors of another length than the query's are no
    candidates.  Scores are exact at any size; one beyond a long is returned
    as its end.
    """
    spark = candidates.sparkSession
    every = staged(candidates.select("vec_id", "q", F.size("q").alias("d")), "topk-candidates")
    asked = staged(queries.select("vec_id", "q", F.size("q").alias("d")), "topk-queries")
    out = []
    for dim in sorted(r["d"] for r in asked.select("d").distinct().collect()):  # vector lengths: nearly always one
        cand, todo, last = every.filter(F.col("d") == dim).select("vec_id", "q"), asked.filter(F.col("d") == dim), None
        longest = cand.agg(F.max(F.array_max(F.transform("q", F.abs)))).first()[0]
        while longest is not None:
            rest = todo if last is None else todo.filter(F.col("vec_id") > last)
            rows = rest.orderBy("vec_id").limit(block).collect()  # one block of queries
            if not rows:
                break
            last = rows[-1]["vec_id"]
            ids = np.array([r["vec_id"] for r in rows], np.int64)
            q = np.array([r["q"] for r in rows], np.float64)
            bound = np.array([sum(int(abs(x)) for x in r) * int(longest) for r in q], object)
            if max(bound) >= EXACT:
                q = _numbers(q, whole=True)
            kth = _kth_scores(cand, ids, q, bound, k)
            out.append(staged(_select(cand, ids, q, bound, kth, k), "topk-block"))
    if not out:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    found = out[0]
    for o in out[1:]:
        found = found.unionByName(o)
    w = Window.partitionBy("query_id").orderBy(F.desc("above"), F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")

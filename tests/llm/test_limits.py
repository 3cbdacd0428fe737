"""Limits of memory and of rows made, on rows built here."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pyarrow as pa

from strata.llm import minhash_dedup, toxicity


def test_toxicity_training_holds_its_matrix_once():
    n, landmarks, rank = 12_000, 80, 60
    rng = np.random.default_rng(1)
    f = pa.chunked_array([pa.array(list(rng.random((n // 3, landmarks), np.float32)), pa.list_(pa.float32())) for _ in range(3)])
    nystrom = rng.normal(size=(landmarks, rank))
    y = np.where(rng.random(n + 1) < 0.4, 1, -1)
    tracemalloc.start()
    x = toxicity.training_matrix(f, nystrom)
    w = toxicity.linear_svm(x, y)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 1.7 * x.nbytes
    whole = np.stack(f.to_numpy()).astype(np.float64) @ nystrom
    assert np.allclose(x[:-1, :-1], whole) and not x[-1, :-1].any() and (x[:, -1] == 1).all()
    # a fixed point of the whole-matrix step
    cost = np.where(y > 0, 1 / (y > 0).sum(), 1 / (y < 0).sum()) * 50.0
    inside = y * (x @ w) < 1
    part = x[inside] * cost[inside, None]
    again = np.linalg.solve(part.T @ x[inside] + np.eye(len(w)) * 0.01, part.T @ y[inside])
    assert np.allclose(w, again, atol=1e-4)


def test_near_copies_make_no_pair_of_each_two(spark, monkeypatch):
    """A group whose similarities lie on both sides of the threshold, not joined by stars: few pairs, every group found."""
    r = random.Random(5)
    first = [f"w{i}" for i in range(90)]
    texts = [" ".join(w if r.random() > rate else f"x{r.randrange(10**6)}" for w in first)
             for rate in (r.choice((0.01, 0.03, 0.08)) for _ in range(60))]
    sets = [{(a, b) for a, b in zip(t.split(), t.split()[1:])} for t in texts]
    root = list(range(60))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = [(i, j) for j in range(60) for i in range(j) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    for i, j in links:
        a, b = sorted((find(i), find(j)))
        root[b] = a
    made, compare = [], minhash_dedup._compare

    def counted(*args, **more):
        made.append(compare(*args, **more))
        return made[-1]

    monkeypatch.setattr(minhash_dedup, "_compare", counted)
    monkeypatch.setattr(minhash_dedup, "_stars", lambda reps, percent: reps.limit(0).selectExpr("node a", "node b"))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    got = {x.doc_id: x.component_id for x in minhash_dedup.near_duplicates(docs, 2, 80).collect()}
    assert got == {i: find(i) for i in range(60)} and len(set(got.values())) > 1
    assert made[0].select("a", "b").distinct().count() < len(links) / 2


def test_forest_joins_what_all_pairs_join():
    x, y = np.array([0, 0, 1, 3, 2]), np.array([1, 2, 2, 4, 3])
    label = np.array([7, 7, 8, 9, 9])
    assert minhash_dedup.forest(x, y, np.array([1, 2, 0, 3, 4]), label) == [1, 4]


def test_bitmaps_differ_in_no_more_bits_than_sets_in_shingles():
    known = minhash_dedup._WordHash()
    s, t = (minhash_dedup.shingles(" ".join(f"w{i}" for i in k), 2, known) for k in (range(300), range(9, 320)))
    bits = [np.frombuffer(minhash_dedup.parity(v), np.uint8) for v in (s, t)]
    assert 0 < np.bitwise_count(bits[0] ^ bits[1]).sum() <= len(np.setxor1d(s, t))

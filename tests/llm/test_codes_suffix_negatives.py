"""Vector codes, suffix-array dedup and hard negatives against brute force, and their edge cases."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import hard_negatives, suffix_dedup, vector_codes

VECS = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT"
DOCS = "doc_id BIGINT, text STRING, n_bytes INT"
NAN, INF = float("nan"), float("inf")


def floats(x):
    return [float(np.float32(v)) for v in x]


# --- vector codes

def brute_codes(rows, dim, parts=8, entries=16, rounds=6):
    kept = [(i, [max(-2**63, min(2**63 - 1, math.floor(4096 * c))) for c in v], lab) for i, v, lab in rows
            if v and len(v) == dim and all(c is not None and math.isfinite(c) for c in v)]
    width = dim // parts
    cut = lambda q, p: q[p * width:(p + 1) * width]
    first = {}
    for i, q, _ in kept:
        if i is not None:
            first[i] = min(first.get(i, q), q)
    books = [[cut(first[i], p) for i in sorted(first)[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), n) for n, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for _, q, _ in kept:
                groups.setdefault(nearest(cut(q, p), books[p])[1], []).append(cut(q, p))
            books[p] = [[sum(c) // len(groups[n]) for c in zip(*groups[n])] if n in groups else e for n, e in enumerate(books[p])]
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    out, per_label = [], Counter()
    for i, q, lab in kept:
        best = [nearest(cut(q, p), books[p]) for p in range(parts)]
        out.append((i, "".join(f"{n:02x}" for _, n in best), min(2**63 - 1, sum(d for d, _ in best)), lab))
        per_label[lab] += out[-1][2]
    return Counter((i, c, e, min(2**63 - 1, per_label[lab]), sha) for i, c, e, lab in out)


@pytest.mark.parametrize("kind", ["plain", "ties", "huge"])
def test_vector_codes_match_brute_force(spark, kind):
    rng = np.random.default_rng(len(kind))
    x = {"plain": rng.normal(size=(150, 16)), "ties": rng.integers(-1, 2, size=(150, 16)) / 4096,
         "huge": rng.normal(size=(60, 16)) * np.repeat([1, 3e5, 1e17, 1e30], 15)[:, None]}[kind]
    rows = [(int(i) * 3 - 20, floats(v), [1, 2, 2, None][i % 4]) for i, v in enumerate(x)]
    rows += [(-999, None, 1), (-998, [], 1), (-997, [NAN] + [0.0] * 15, 1), (-996, [None] + [0.0] * 15, None), (-995, [INF] * 16, 1),
             (500, [0.5] * 8, 2), (501, [0.5] * 9, 2), (None, floats(x[0]), 2), (-20, floats(x[1]), 1), (-17, floats(x[1]), 1)]
    df = spark.createDataFrame(rows, VECS).withColumn("code", F.lit("clash")).withColumn("q", F.lit(1))
    got = vector_codes.compress(df.repartition(3))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert Counter(map(tuple, got.collect())) == brute_codes(rows, 16)


def test_vector_codes_of_few_and_no_rows(spark):
    few = spark.createDataFrame([(3, [1.0] * 8, 1), (5, [2.0] * 8, None)], VECS)
    assert Counter(map(tuple, vector_codes.compress(few).collect())) == brute_codes([(3, [1.0] * 8, 1), (5, [2.0] * 8, None)], 8)
    assert vector_codes.compress(few.limit(0)).count() == 0
    assert vector_codes.compress(few.withColumn("vec_id", F.lit(None).cast("bigint"))).count() == 0


def test_bounds_prune_and_stay_exact():
    rng = np.random.default_rng(3)
    centre = rng.integers(-9000, 9000, size=(16, 8))
    x = centre[rng.integers(0, 16, 2000)] + rng.integers(-300, 300, size=(2000, 8))
    pivots = vector_codes.pick_pivots(centre)
    code, d, _ = vector_codes.nearest(x, vector_codes.distances(x, pivots), centre, pivots)
    full = ((x[:, None] - centre[None]) ** 2).sum(2)
    assert (code == full.argmin(1)).all() and (d == full.min(1)).all()
    assert vector_codes.evaluated_share(x, centre) < 0.5


# --- suffix-array dedup

def brute_removed(texts, window):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(t[i:i + window] for t in raw for i in range(len(t) - window + 1))
    out = []
    for t in raw:
        gone = bytearray(len(t))
        for i in range(len(t) - window + 1):
            if seen[t[i:i + window]] > 1:
                gone[i:i + window] = b"\1" * window
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(t), sum(gone), spans, bytes(c for c, g in zip(t, gone) if not g)))
    return out


def corpus(seed, window):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randrange(1, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, texts = prose(window // 2), [prose(r.randrange(0, 150)) for _ in range(50)]
    for t in list(texts[:25]):
        cut = r.randrange(len(t) + 1)
        texts.append(t[:cut] + r.choice("xyz") + t[cut:])  # near copies
    texts += [prose(r.randrange(0, 9)) + passage + prose(r.randrange(0, 9)) for _ in range(60)]  # every edge of one passage
    texts += [passage[i:i + window + 3] for i in range(0, 40, 7)]
    texts += [texts[3]] * 5 + [None, "", None, "a" * 3 * window, "ab" * 2 * window, "aab" * window, "c" * window, "d" * (window - 1), "d" * (window - 1)]
    texts += [passage[:window] + "é" + passage[:window] + "ß"]
    return texts


@pytest.mark.parametrize("window,members", [(200, 4096), (24, 4096), (24, 8), (100, 2), (16, 4096), (150, 64)])
def test_repeats_match_brute_force(spark, window, members):
    texts = corpus(window + members, window)
    df = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], DOCS).repartition(5)
    got = suffix_dedup.remove_repeats(df, window, members=members)
    assert got.columns == ["doc_id", "n_bytes", "spans", "n_removed", "kept"]
    want = brute_removed(texts, window)
    for x in got.collect():
        n, removed, spans, kept = want[x.doc_id]
        assert (x.n_bytes, x.n_removed, len(x.spans), bytes(x.kept)) == (n, removed, spans, kept), (x.doc_id, texts[x.doc_id])
        assert sum(s.end - s.start for s in x.spans) == removed
    assert got.count() == len(texts)


def test_repeats_with_repeated_ids_clashes_and_empty_table(spark):
    df = spark.createDataFrame([(1, "x" * 250, 9), (1, "x" * 250, 9), (None, None, None), (2, "y" * 199, 1)], DOCS)
    got = suffix_dedup.remove_repeats(df, carry=("doc_id", "n_bytes"))
    assert got.columns == ["doc_id", "n_bytes", "spans", "n_removed", "kept"]  # the given column replaces the output
    assert sorted(((x.doc_id or 0), x.n_bytes or 0, x.n_removed) for x in got.collect()) == [(0, 0, 0), (1, 9, 250), (1, 9, 250), (2, 1, 0)]
    assert suffix_dedup.remove_repeats(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(df, window=8)


def test_texts_beyond_a_chunk(spark):
    r = random.Random(1)
    noise = [bytes(r.choices(range(97, 123), k=2 << 20)).decode() for _ in range(2)]
    texts = [noise[0] + "a" * 3_000_000 + noise[1], noise[1][-500:] + "tail", noise[0][1000:1199]]
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], DOCS)
    got = {x.doc_id: [(s.start, s.end) for s in x.spans] for x in suffix_dedup.remove_repeats(df).drop("kept").collect()}
    n = 2 << 20
    lead = 1 if noise[0].endswith("a") else 0  # the run of one letter takes what touches it
    trail = len(noise[1]) - len(noise[1].lstrip("a"))
    assert got[0] == [(n - lead, n + 3_000_000 + trail), (2 * n + 3_000_000 - 500, 2 * n + 3_000_000)]
    assert got[1] == [(0, 500)] and got[2] == []


def test_every_window_lies_in_one_piece():
    texts = [bytes([i]) * n for i, n in enumerate((0, 10, 19, 20, 21, 64, 200, 5, 333))]
    seen = Counter()
    for some in suffix_dedup._pieces(texts, 20, 50):
        assert sum(len(p[2]) for p in some) <= 50 + 19
        for i, lo, piece in some:
            assert texts[i][lo:lo + len(piece)] == piece
            seen.update((i, lo + k) for k in range(len(piece) - 19))
    assert seen == Counter((i, k) for i, t in enumerate(texts) for k in range(len(t) - 19))


# --- hard negatives

def brute_negatives(rows):
    q = {}
    for i, v, lab in rows:
        if i is None or lab is None or not v or any(c is None or not math.isfinite(c) for c in v):
            continue
        new = ([math.floor(256 * c) for c in v], lab)
        q[i] = min(q.get(i, new), new)
    out = []
    for a in q:
        if a % 50:
            continue
        score = {i: sum(x * y for x, y in zip(q[a][0], q[i][0])) for i in q if i != a and len(q[i][0]) == len(q[a][0])}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if q[i][1] == q[a][1]][:5]:
            hard = [i for i in order if q[i][1] != q[a][1] and 50 * score[p] <= 100 * score[i] <= 95 * score[p]][:3]
            out += [(a, p, n + 1, i, score[p], score[i]) for n, i in enumerate(hard)]
    return sorted(out)


@pytest.mark.parametrize("kind,block,slot", [("plain", 8192, 32768), ("ties", 3, 40), ("large", 8192, 50)])
def test_negatives_match_brute_force(spark, kind, block, slot):
    rng = np.random.default_rng(9)
    x = {"plain": rng.normal(size=(300, 65)), "ties": rng.integers(0, 3, size=(300, 7)) / 256, "large": rng.normal(size=(300, 5)) * 1.5e6}[kind]
    rows = [(int(i) * 5, floats(v), int(rng.integers(0, 3))) for i, v in enumerate(x)]
    odd = [(9000, None, 1), (9050, [NAN] * 65, 1), (9100, [None], 2), (9150, floats(x[3]), None), (9200, [], 1), (None, floats(x[4]), 1),
           (0, floats(x[5]), 2), (9250, [1.0, 2.0], 0), (9251, [1.0, 2.5], 0), (9252, [1.0, 1.0], 1), (9253, [-1.0, 1.0], 1)]
    df = spark.createDataFrame(rows + odd, VECS).withColumn("rank", F.lit(0)).withColumn("q", F.lit("x"))
    v = hard_negatives.prepared(df)
    got = hard_negatives.mine(v.filter("vec_id % 50 = 0"), v, block=block, slot=slot)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == brute_negatives(rows + odd)


def test_scores_beyond_a_long_count_as_its_end(spark):
    rows = [(0, [1e9] * 4, 0), (1, [1e9] * 4, 0), (2, [8e8] * 4, 1), (3, [24414.0] * 4, 1), (4, [1.0] * 4, 1), (5, [-1e9] * 4, 1)]
    v = hard_negatives.prepared(spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>, label INT"))
    got = hard_negatives.mine(v.filter("vec_id = 0"), v)
    assert [tuple(x) for x in got.collect()] == [(0, 1, 1, 3, 2**63 - 1, 4 * 256 * 10**9 * 256 * 24414)]


def test_negatives_of_empty_tables(spark):
    v = hard_negatives.prepared(spark.createDataFrame([(0, [1.0], 1), (1, [1.0], 1)], VECS))
    assert hard_negatives.mine(v.limit(0), v).count() == 0
    assert hard_negatives.mine(v, v.limit(0)).count() == 0
    assert hard_negatives.mine(v, v).count() == 0  # no other label


@pytest.mark.parametrize("shape", [(1, 1, 1), (33, 64, 35), (100, 7, 90), (64, 64, 64), (129, 65, 70), (5, 200, 3)])
def test_strassen_equals_plain_product(shape):
    rng = np.random.default_rng(sum(shape))
    a, b = rng.integers(-2**20, 2**20, shape[:2]), rng.integers(-2**20, 2**20, shape[1:])
    assert (hard_negatives.strassen(a, b, leaf=4) == a @ b).all()
    assert (hard_negatives.strassen(a.astype(object), b.astype(object), leaf=16) == (a.astype(object) @ b.astype(object))).all()

"""Near-duplicate and search operators against brute force, and their edge cases."""

import math
import random
import re

import numpy as np
import pytest

from strata.llm import embedding_dedup, line_dedup, minhash_dedup, topk_search
from strata.llm.common import components

DOCS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
VECS = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT"


def union(pairs, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], DOCS)


def prose(seed, n, words=60, vocabulary=400):
    r = random.Random(seed)
    return [" ".join(f"w{int(r.paretovariate(0.6)) % vocabulary}" for _ in range(words)) for _ in range(n)]


def edited(text, r, n):
    words = text.split()
    for _ in range(n):
        words[r.randrange(len(words))] = f"new{r.randrange(10**6)}"
    return " ".join(words)


def test_components_of_chains_stars_and_loops(spark):
    r = random.Random(1)
    pairs = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(300)] + [(5000, 5000), (None, 3)]
    pairs += [(r.randrange(3000, 3400), r.randrange(3000, 3400)) for _ in range(250)]
    real = [p for p in pairs if None not in p and p[0] != p[1]]
    want = union(real, {x for p in real for x in p})
    got = components(spark.createDataFrame(pairs, "src BIGINT, dst BIGINT"))
    assert {x.node: x.root for x in got.collect()} == {k: v for k, v in want.items() if k != v}
    assert components(spark.createDataFrame([], "src BIGINT, dst BIGINT")).count() == 0


def word_shingles(text, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])


@pytest.mark.parametrize("size", [2, 5])
def test_minhash_matches_brute_force(spark, size):
    r = random.Random(size)
    base = prose(3, 40)
    texts = base + [edited(t, r, k) for t in base[:20] for k in (1, 2, 4)] + [base[0]] * 5
    passage = " ".join(prose(9, 1, 200))  # shared by many documents that are no copies
    texts += [passage + " " + t for t in prose(11, 90, 40)]
    texts += [None, "", " \t\n", "one", "One", "two words", "é É", "x " * 3000, " a b"]
    got = minhash_dedup.near_duplicates(docs_of(spark, texts), size, 80)
    sets = [word_shingles(t, size) for t in texts]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    root = union(links, range(len(sets)))
    assert {x.doc_id: (x.n_shingles, x.component_id, x.kept) for x in got.collect()} == {
        i: (len(s), root[i], root[i] == i) for i, s in enumerate(sets)}


def test_minhash_keeps_one_of_each_group(spark):
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g"), (2, "a b c d e f g"), (3, None), (4, ""), (4, ""), (None, "q r s t u v"),
            (5, "h i j k l m"), (5, "other words are in this one")]
    docs = spark.createDataFrame([(i, t, 7) for i, t in rows], "doc_id BIGINT, text STRING, component_id INT")
    kept = minhash_dedup.keep_one(docs)
    assert kept.columns == ["doc_id", "text", "component_id"]
    assert sorted(map(str, [(x.doc_id, x.text) for x in kept.collect()])) == sorted(map(str, [
        (1, "a b c d e f g"), (3, None), (4, ""), (None, "q r s t u v"), (5, "h i j k l m"), (5, "other words are in this one")]))
    assert minhash_dedup.keep_one(docs.limit(0)).count() == 0


def test_minhash_null_ids_do_not_split_copies(spark):
    text, near = "one two three four five six seven eight nine ten eleven twelve", "zero " * 3
    rows = [(None, text), (5, text), (7, text), (None, near + "a b c"), (None, near + "a b c"), (9, None), (None, None)]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id BIGINT, text STRING, _h STRING, root INT")
    got = minhash_dedup.near_duplicates(docs, 2, 80).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [
        (None, 11, 5, False), (5, 11, 5, True), (7, 11, 5, False), (None, 4, None, True), (None, 4, None, True),
        (9, 0, 9, True), (None, 0, None, True)]))
    kept = minhash_dedup.keep_one(docs)
    assert kept.columns == ["doc_id", "text", "_h", "root"]
    assert sorted(map(str, map(tuple, kept.collect()))) == sorted(map(str, [
        (5, text, "x", 1), (None, near + "a b c", "x", 1), (9, None, "x", 1), (None, None, "x", 1)]))


def test_embedding_links_match_brute_force(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 16))
    near = x[:30].repeat(12, 0) + rng.normal(scale=0.12, size=(360, 16))
    x = np.concatenate([x, near, x[:5], x[:3] * 7]).astype(np.float32)
    rows = [(i, [float(c) for c in v], 0) for i, v in enumerate(x)]
    odd = [(9001, None, 0), (9002, [0.0] * 16, 0), (9003, [float("nan")] + [1.0] * 15, 0), (9004, [None] + [1.0] * 15, 0),
           (9005, [float("inf")] * 16, 0), (9006, [], 0), (9007, [1.0, 2.0], 0), (9008, [2.0, 4.0], 0)]
    got = embedding_dedup.near_duplicates(spark.createDataFrame(rows + odd, VECS), 0.95)
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    link = u @ u.T >= 0.95
    pairs = [(int(a), int(b)) for a, b in zip(*np.nonzero(link)) if a != b]
    root = union(pairs, range(len(x)))
    want = {i: (int(link[i].sum()) - 1, root[i], root[i] == i) for i in range(len(x))}
    want |= {r[0]: (0, r[0], True) for r in odd[:6]} | {9007: (1, 9007, True), 9008: (1, 9007, False)}
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got.collect()} == want


def test_embedding_large_bucket_is_compared_in_blocks(spark):
    rng = np.random.default_rng(2)
    x = np.ones((600, 8)) + rng.normal(scale=0.01, size=(600, 8))  # all near copies: one bucket beyond a block
    df = spark.createDataFrame([(i, [float(c) for c in v], 0) for i, v in enumerate(x)], VECS)
    got = embedding_dedup.near_duplicates(df, 0.95).collect()
    assert all(r.n_links == 599 and r.component_id == 0 for r in got) and sum(r.kept for r in got) == 1
    assert embedding_dedup.near_duplicates(df.limit(0), 0.95).count() == 0
    signs, tables = embedding_dedup.layout(10**6, 0.95)
    assert 1 - (1 - (1 - math.acos(0.95) / math.pi) ** signs) ** tables >= embedding_dedup.RECALL


@pytest.mark.parametrize("block", [4096, 3])
def test_topk_matches_brute_force_with_ties(spark, block):
    rng = np.random.default_rng(6)
    x = rng.integers(-3, 4, size=(400, 6)) / 256.0  # many equal scores
    rows = [(i * 5, [float(c) for c in v], 0) for i, v in enumerate(x)] + [
        (50000, None, 0), (50050, [float("nan")] * 6, 0), (50100, [None] * 6, 0), (0, [float(c) for c in x[0]], 0)]
    v = topk_search.vectors(spark.createDataFrame(rows, VECS))
    got = topk_search.topk(v.filter("vec_id % 50 = 0"), v, 5, block=block)
    q = np.floor(256 * x).astype(int)
    ids, want = np.arange(400) * 5, []
    for i in np.flatnonzero(ids % 50 == 0):
        s = q @ q[i]
        best = [j for j in np.lexsort((ids, -s)) if j != i][:5]
        want += [(int(ids[i]), n + 1, int(ids[j]), int(s[j])) for n, j in enumerate(best)]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_topk_few_candidates_and_empty(spark):
    v = topk_search.vectors(spark.createDataFrame([(0, [1.0, 2.0], 0), (50, [-1.0, 0.5], 0), (51, [0.0, 0.0], 0)], VECS))
    got = sorted(map(tuple, topk_search.topk(v.filter("vec_id % 50 = 0"), v, 5).collect()))
    assert got == [(0, 1, 50, 0), (0, 2, 51, 0), (50, 1, 0, 0), (50, 2, 51, 0)]
    assert topk_search.topk(v.limit(0), v).count() == 0 and topk_search.topk(v, v.limit(0)).count() == 0


def test_topk_of_unequal_lengths_and_large_components(spark):
    rows = [(0, [1e12, 1.0], 0), (50, [1e12, 2.0], 0), (51, [-1e12, 1.0], 0), (52, [1e5, 1e5], 0), (53, [1e5, 1e5], 0), (100, [1.0, 2.0, 3.0], 0),
            (54, [1.0, 0.0, 0.0], 0), (150, [1.0], 0), (55, [1e30, 0.0], 0)]
    ddl = "vec_id BIGINT, embedding ARRAY<DOUBLE>, label INT"
    v = topk_search.vectors(spark.createDataFrame(rows, ddl))
    got = sorted(map(tuple, topk_search.topk(v.filter("vec_id % 50 = 0"), v, 3).collect()))
    top, mid = 2**63 - 1, 256 * 10**12 * 256 * 10**5
    want = []
    for i, x in ((0, 1), (50, 2)):
        other = 50 - i
        both = mid + 256 * 256 * x * 10**5
        want += [(i, 1, other, top), (i, 2, 55, top), (i, 3, 52, min(top, both))]
    assert [g for g in got if g[0] in (0, 50)] == sorted(want)
    assert [g for g in got if g[0] == 100] == [(100, 1, 54, 65536)] and not [g for g in got if g[0] == 150]


def test_line_dedup_matches_brute_force(spark):
    r = random.Random(5)
    base = prose(8, 60, 14, 150) + prose(13, 6, 150, 900)
    lines = base + [edited(t, r, 1) for t in base] + [edited(t, r, 3) for t in base[:30]] + base[:20]
    lines += ["a b", "a b", "the end", "", "  ", "One two THREE four five", "one two three  four five "]
    r.shuffle(lines)
    texts = ["\n".join(lines[i:i + 7]) for i in range(0, len(lines), 7)] + [None, "", texts_tail()]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)] + [(0, texts[0], "en", "s", 0)]  # a repeated row
    got = line_dedup.dedup(spark.createDataFrame(rows, DOCS), ["doc_id", "lang"]).collect()
    kept, want = [], {}
    for i, t in enumerate(texts):
        if t is None:
            want[i] = (0, 0, None)
            continue
        out = []
        for line in t.split("\n"):
            s = frozenset(line.lower().split())
            if len(s) >= 5 and any(100 * len(s & o) >= 80 * len(s | o) for o in kept):
                out.append(None)
            else:
                out.append(line)
            if len(s) >= 5:
                kept.append(s)
        want[i] = (len(out), out.count(None), "\n".join(x for x in out if x is not None))
    assert len(got) == len(rows)
    assert {x.doc_id: (x.n_lines, x.n_removed, x.clean) for x in got} == want


def texts_tail():
    return "\n".join(["word " * 5000, "it is été and höhe and ño", "it is été and höhe and ño !"])


def test_line_dedup_of_empty_table(spark):
    assert line_dedup.dedup(spark.createDataFrame([], DOCS), ["doc_id"]).count() == 0


def test_minhash_batches_reach_the_recall_at_any_depth():
    one = [minhash_dedup.miss(80, 12, d) for d in range(1, minhash_dedup.DEPTH + 1)]
    assert one == sorted(one) and one[4] < 1 - minhash_dedup.RECALL < one[9] < 0.02 and 0.1 < one[23] < 0.16
    assert (minhash_dedup.minwise(np.arange(200, dtype=np.uint64)) != minhash_dedup.minwise(np.arange(200, dtype=np.uint64), 1)).all()


def test_minhash_adds_trees_until_the_recall_is_met(spark):
    texts = [" ".join([f"b{k}_{i}" for i in range(89)] + [f"{side}{k}_{i}" for i in range(11)]) for k in range(60) for side in "xy"]
    got = {x.doc_id: x.component_id for x in minhash_dedup.near_duplicates(docs_of(spark, texts), 1, 80, trees=1).collect()}
    wrong = [i for i in got if got[i] != i - i % 2]  # all pairs are at the threshold (89 of 111)
    assert not wrong, f"{len(wrong)} of 60 links missed"

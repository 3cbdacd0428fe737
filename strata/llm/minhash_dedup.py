"""MinHash near-duplicates by a chosen-path set similarity join.

Documents with equal shingle sets form one class.  In each of several
independent trees a node picks minwise coordinates by its path and sends its
classes to the child of their value there; small nodes are compared
exhaustively, larger ones branch again.  Nodes pick 1/threshold coordinates
on average, so pairs at the threshold keep meeting while others part.

A first pass of stars joins the bulk of large groups, so nodes whose members
are already connected need no pairs.  Nodes that stay large to the last level
are compared in blocks, exactly.  Every link is confirmed on full sets.

A pair at the threshold survives fewer of the deeper trees.  Classes whose
nodes branched too deep for RECALL get further batches of trees, on minwise
tokens drawn anew, until the product of their batches' misses is small enough.

Only groups are asked for, so a block with many candidate pairs names a
spanning forest of them, the likeliest pairs first.  Where full sets refute a
pair of a forest and its ends stay apart, the node names all its other pairs
across groups: no link that joins two groups is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import components, marks, staged

COORDS = 128  # minwise tokens of a document, drawn anew for each batch of trees
TREES = 12  # trees of a batch
RECALL = 0.999  # of pairs at the threshold, whatever the depth of their nodes
LEAF = 64  # classes of a node that are compared exhaustively
FEW = 512  # classes outside the main component of a node, if that is larger, that are compared with all of it
DEPTH = 24  # levels before the remaining large nodes are compared in blocks
STARS = 6  # star rounds, each keyed by STAR_COORDS minwise tokens
STAR_COORDS = 6
PAIRS = 1 << 16  # pairs of a block that are compared at once
BITS = 1024  # bits of a set's parity bitmap


@cache
def _draw(batch: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers and masks of the minwise hashes of a batch of trees."""
    mult = np.random.default_rng(7 + 1000 * batch).integers(1, 2**63, COORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return mult, np.random.default_rng(8 + 1000 * batch).integers(0, 2**63, COORDS, dtype=np.uint64)


def _extra(percent: int) -> int:
    """Per cent of nodes with a second coordinate."""
    return 100 * (100 - percent) // percent


def miss(percent: int, trees: int, depth: int) -> float:
    """Share of pairs at the threshold that one batch of trees misses if their nodes branch ``depth`` times.

    Given how many of the COORDS tokens are equal, nodes pick independently.
    Pairs below the sketch bound count as missed.
    """
    t, two, out = percent / 100, _extra(percent) / 100 * (1 - 1 / COORDS), 0.0
    for equal in range(COORDS + 1):
        share, p = equal / COORDS, 1.0
        for _ in range(depth):
            p = (1 - two) * share * p + two * (1 - (1 - share * p) ** 2)
        weight = math.comb(COORDS, equal) * t**equal * (1 - t) ** (COORDS - equal)
        out += weight * ((1 - p) ** trees if equal >= _least_equal(percent) else 1.0)
    return out


class _WordHash(dict):
    """64-bit hash of a word, remembered up to a fixed number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingles(text: str | None, size: int, cache: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all ``size``-word shingles; fewer words: the whole sequence as one."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    k = min(size, len(h))
    out = np.full(len(h) - k + 1, k, np.uint64)
    for i in range(k):
        out = (out ^ h[i:len(h) - k + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.unique(out)


def minwise(s: np.ndarray, batch: int = 0) -> np.ndarray:
    """The minwise token (16 bits: a clash only adds a candidate) of a non-empty set at each coordinate."""
    mult, xor = _draw(batch)
    low = np.full(COORDS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(s), 4096):
        low = np.minimum(low, ((s[None, at:at + 4096] ^ xor[:, None]) * mult[:, None]).min(1))
    return (low >> np.uint64(48)).astype(">u2")


def parity(s: np.ndarray) -> bytes:
    """Parity bitmap of a set: each shingle flips one bit, so two bitmaps differ in no more bits than the sets in shingles."""
    return np.packbits(np.bincount((s >> np.uint64(54)).astype(np.int64), minlength=BITS).astype(np.uint8) & 1).tobytes()


def _sets(docs: DataFrame, size: int, full: bool, batch: int = 0) -> DataFrame:
    """doc_id, h (hash of the text), n, d1, d2 (digest of the set) and ``sketch`` with ``bits`` or, with ``full``, the set as ``items``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "h", "n", "d1", "d2", *(["items"] if full else ["sketch", "bits"])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHash()
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                n, d, data, bits = [], [], [], []
                for text in part.column(1).to_pylist():
                    s = shingles(text, size, known)
                    x = xxhash.xxh3_128_digest(s.tobytes())
                    n.append(len(s))
                    d.append(np.frombuffer(x, np.int64))
                    data.append((s.tobytes() if full else minwise(s, batch).tobytes()) if len(s) else b"")
                    bits.append(b"" if full else parity(s))
                d = np.array(d).reshape(-1, 2)
                cols = [part.column(0), part.column(2), pa.array(n, pa.int64()), pa.array(d[:, 0].copy()), pa.array(d[:, 1].copy()),
                        pa.array(data, pa.binary()), pa.array(bits, pa.binary())]
                yield pa.RecordBatch.from_arrays(cols[:len(names)], names)

    return docs.select("doc_id", "text", F.xxhash64("text").alias("h")).mapInArrow(
        run, f"doc_id {kind}, h bigint, n bigint, d1 bigint, d2 bigint, {', '.join(f'{c} binary' for c in names[5:])}")


def _token(coord: Column) -> Column:
    return F.substring(F.col("sketch"), coord * 2 + 1, F.lit(2))


def _sig() -> Column:
    """One byte of each token of ``sketch``."""
    return F.unhex(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(COORDS - 1)), lambda i: F.hex(
        F.substring(F.col("sketch"), i * 2 + 2, F.lit(1)))), ""))


def _read_again(nodes: DataFrame, reps: DataFrame, docs: DataFrame, size: int, name: str, batch: int | None = None) -> DataFrame:
    """node and its full set as ``items`` or, with ``batch``, its ``sketch`` of that batch, from the texts."""
    last = "items" if batch is None else "sketch"
    want = staged(reps.join(nodes, "node", "left_semi").select("node", "doc_id", "d1", "d2"), name + "-used")
    some = docs.filter(marks(want.select("doc_id").distinct(), "doc_id"))  # texts are not shuffled
    s, w = _sets(some, size, batch is None, batch or 0).alias("s"), want.alias("w")
    same = F.col("s.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("s.d1") == F.col("w.d1")) & (F.col("s.d2") == F.col("w.d2"))
    return staged(s.join(w, same).groupBy("node").agg(F.first(last).alias(last)), name + "-sets")


def _confirmed(pairs: DataFrame, reps: DataFrame, docs: DataFrame, size: int, percent: int, name: str) -> DataFrame:
    """Pairs (a, b) whose full sets have 100 * common >= percent * union."""
    used = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    items = _read_again(used, reps, docs, size, name)
    both = (
        pairs.join(items.select(F.col("node").alias("a"), F.col("items").alias("x")), "a")
        .join(items.select(F.col("node").alias("b"), F.col("items").alias("y")), "b").select("a", "b", "x", "y")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column(2), b.column(3)):
                s, t = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                at = np.minimum(np.searchsorted(t, s), len(t) - 1)
                common = int((t[at] == s).sum())
                keep.append(100 * common >= percent * (len(s) + len(t) - common))
            yield b.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return staged(both.mapInArrow(run, "a bigint, b bigint"), name)


def _least_equal(percent: int) -> float:
    """Equal tokens below which a pair is no candidate: four standard deviations under what the threshold gives."""
    t = percent / 100
    return COORDS * (t - 4 * np.sqrt(t * (1 - t) / COORDS))


def _close(x: np.ndarray, y: np.ndarray, sig: np.ndarray, bits: np.ndarray, n: np.ndarray, percent: int) -> tuple[np.ndarray, ...]:
    """Those of the pairs (x, y) that may link, and the share of shingles by which their bitmaps differ.

    Exact bounds by set size and by the bitmaps; enough equal tokens (``sig`` has one byte of each).
    """
    low, high = np.minimum(n[x], n[y]), np.maximum(n[x], n[y])
    use = 100 * low >= percent * high
    x, y = x[use], y[use]
    apart, both = np.bitwise_count(bits[x] ^ bits[y]).sum(1, dtype=np.int64), n[x] + n[y]
    use = (100 + percent) * apart <= (100 - percent) * both
    x, y, share = x[use], y[use], apart[use] / both[use]
    use = (sig[x] == sig[y]).sum(1) >= _least_equal(percent)
    return x[use], y[use], share[use]


def forest(x: np.ndarray, y: np.ndarray, order: np.ndarray, label: np.ndarray) -> list[int]:
    """Numbers of the pairs (x, y) that, taken in ``order``, first join two groups; groups start as ``label``."""
    root: dict[int, int] = {}

    def find(v: int) -> int:
        while (up := root.get(v, v)) != v:
            root[v] = v = root.get(up, up)
        return v

    out = []
    a, b = label[x].tolist(), label[y].tolist()
    for k in order.tolist():
        u, v = find(a[k]), find(b[k])
        if u != v:
            root[u] = v
            out.append(k)
    return out


def _compare(rows: DataFrame, percent: int, name: str, every: bool = False) -> DataFrame:
    """Candidate pairs (a < b, labels differ) inside each block, and ``path`` where a block has more than it names.

    With more pairs than members a block names a spanning forest of them,
    unless ``every`` one is asked for.  The pairs may repeat.
    ``rows``: path, how, c, odd, node, label, n, sig, bits.  A leaf is one block.
    Of a node with one large component and ``few`` other members, each of
    ``c`` blocks has a part of the large one and all the others.  Of any
    other (``grid``) ``c`` parts meet two by two.
    """
    chunk = F.pmod(F.xxhash64("node"), F.col("c")).cast("int")
    block = lambda i, j: F.struct(i.alias("i"), j.alias("j"))
    each = F.sequence(F.lit(0), F.col("c") - 1)
    blocks = (
        F.when(F.col("how") == "leaf", F.array(block(F.lit(0), F.lit(0))))
        .when((F.col("how") == "few") & F.col("odd"), F.transform(each, lambda k: block(k, k)))
        .when(F.col("how") == "few", F.array(block(F.col("chunk"), F.col("chunk"))))
        .otherwise(F.transform(each, lambda k: block(F.least("chunk", k), F.greatest("chunk", k))))
    )
    spread = (
        rows.withColumn("chunk", chunk).withColumn("at", F.explode(blocks)).groupBy("path", "at.i", "at.j")
        .agg(F.collect_list(F.struct("node", "label", "n", "sig", "chunk", "bits")).alias("m"))
        .select("i", "j", "m", "path").filter(F.size("m") > 1)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found, more = [], []
            flat, ends = b.column(2).flatten(), np.cumsum([0, *(len(x) for x in b.column(2))])
            node, label, n, part = (flat.field(k).to_numpy(zero_copy_only=False) for k in (0, 1, 2, 4))
            sig = np.frombuffer(b"".join(flat.field(3).to_pylist()), np.uint8).reshape(-1, COORDS)
            bits = np.frombuffer(b"".join(flat.field(5).to_pylist()), np.uint64).reshape(-1, BITS // 64)
            i, j, path = b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(3).to_numpy()
            for k in range(b.num_rows):
                s = slice(ends[k], ends[k + 1])
                ok = (label[s][:, None] != label[s][None, :]) & (node[s][:, None] < node[s][None, :])
                if i[k] != j[k]:
                    ok &= part[s][:, None] != part[s][None, :]
                if not ok.any():
                    continue
                x, y = np.nonzero(ok)
                x, y, share = (np.concatenate(c) for c in zip(*(
                    _close(x[at:at + PAIRS], y[at:at + PAIRS], sig[s], bits[s], n[s], percent) for at in range(0, len(x), PAIRS))))
                if len(x):
                    some, left = slice(None), False
                    if not every and len(x) > len(ok):
                        some, left = forest(x, y, np.argsort(share, kind="stable"), label[s]), True
                    found.append((node[s][x][some], node[s][y][some], np.full(len(x), path[k] if left else 0)[some]))
                    more.append(np.full(len(found[-1][0]), left))
            if found:
                a, z, at = (np.concatenate(c) for c in zip(*found))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a), pa.array(z), pa.array(at, mask=~np.concatenate(more))], ["a", "b", "path"])

    return staged(spread.mapInArrow(run, "a bigint, b bigint, path bigint"), name)


def _stars(reps: DataFrame, percent: int) -> DataFrame:
    """For each class the likeliest of the smallest classes that share several minwise tokens with it.

    A few rounds name one head each; the head with the most equal tokens
    stays, if there are enough of them.
    """
    keys = [F.xxhash64(F.lit(r), *[_token(F.lit((r * STAR_COORDS + i) * 7 % COORDS)) for i in range(STAR_COORDS)])
            for r in range(STARS)]
    k = reps.select("node", F.explode(F.array(*keys)).alias("key"))
    heads = k.groupBy("key").agg(F.min("node").alias("a"), F.count(F.lit(1)).alias("m")).filter("m > 1").drop("m")
    pairs = k.join(heads, "key").filter(F.col("a") < F.col("node")).select("a", F.col("node").alias("b")).distinct()
    side = lambda c: reps.select(F.col("node").alias(c), F.col("sig").alias(f"{c}_sig"), F.col("n").alias(f"{c}_n"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").filter(
        100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint8).reshape(-1, COORDS) for c in (2, 3))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array((x == y).sum(1))], ["a", "b", "same"])

    same = both.select("a", "b", "a_sig", "b_sig").mapInArrow(run, "a bigint, b bigint, same bigint")
    return same.filter(F.col("same") >= _least_equal(percent)).groupBy("b").agg(F.max_by("a", "same").alias("a")).select("a", "b")


def _trees(base: DataFrame, percent: int, trees: int, batch: int,
           before: DataFrame | None = None) -> tuple[DataFrame | None, DataFrame | None]:
    """Nodes of one batch of trees to compare, and the classes (node, bound) that need another batch.

    The first has path, how, c, odd, node, as ``_compare`` takes them.
    ``base``: node, label, sketch.  ``bound`` is the logarithm of the
    miss of all batches so far, at the deepest node of the class: pairs never
    branch oftener than either class.
    """
    extra = _extra(percent)

    def branch(rows: DataFrame) -> DataFrame:
        """Children of each row (path, node, sketch): one coordinate, and a second in as many nodes as 1/t asks."""
        pick = lambda salt: F.pmod(F.xxhash64("path", F.lit(salt)), F.lit(COORDS)).cast("int")
        two = (F.pmod(F.xxhash64("path", F.lit(3)), F.lit(100)) < extra) & (pick(1) != pick(2))
        c = F.explode(F.when(two, F.array(pick(1), pick(2))).otherwise(F.array(pick(1)))).alias("coord")
        return rows.select("path", "node", "sketch", c).select(
            F.xxhash64("path", "coord", _token(F.col("coord"))).alias("path"), "node")

    first = F.sequence(F.lit(batch * trees + 1).cast("bigint"), F.lit((batch + 1) * trees).cast("bigint"))
    live = branch(base.select(F.explode(first).alias("path"), "node", "sketch"))
    misses = [miss(percent, trees, d) for d in range(1, DEPTH + 1)]
    met, deep, tag = None, None, f"{batch}-" if batch else ""
    if misses[0] > 1 - RECALL:  # so few trees that even a leaf at the first level is not enough
        deep = base.select("node", F.lit(0).alias("level"))
    for level in range(1, DEPTH + 1):
        rows = staged(live.join(base.select("node", "label"), "node"), f"tree-{tag}{level}")
        per = rows.groupBy("path", "label").agg(F.count(F.lit(1)).alias("k"))
        nodes = per.groupBy("path").agg(
            F.sum("k").alias("total"), F.max("k").alias("most"), F.max_by("label", "k").alias("main"))
        nodes = nodes.filter("total > most")  # others hold one component only
        rest = F.col("total") - F.col("most")
        few = (rest <= LEAF) | ((rest <= FEW) & (rest < F.col("most")))
        how = F.when(F.col("total") <= LEAF, "leaf").when(few, "few").otherwise("more" if level < DEPTH else "grid")
        # as many of the main component in a block as there are others: each member is sent about twice
        parts = F.when(few, F.col("most") / F.greatest(F.lit(LEAF), rest)).otherwise(F.col("total") / LEAF)
        nodes = staged(nodes.select("path", "main", how.alias("how"), F.ceil(parts).cast("int").alias("c")),
                       f"nodes-{tag}{level}")
        kinds = {r["how"] for r in nodes.select("how").distinct().collect()}
        if kinds - {"more"}:
            here = rows.join(nodes.filter("how != 'more'"), "path").select(
                "path", "how", "c", (F.col("label") != F.col("main")).alias("odd"), "node")
            met = here if met is None else met.unionByName(here)
        if "more" not in kinds:
            break
        more = rows.join(nodes.filter("how = 'more'").select("path"), "path", "left_semi")
        if misses[level] > 1 - RECALL:  # misses of nodes one level down
            at = more.select("node", F.lit(level).alias("level"))
            deep = at if deep is None else deep.unionByName(at)
        live = branch(more.select("path", "node").join(base.select("node", "sketch"), "node"))
    if deep is None:
        return met, None
    logs = F.array(*[F.lit(math.log(m)) for m in misses])
    left = deep.groupBy("node").agg(F.max("level").alias("level")).withColumn("bound", F.get(logs, F.col("level")))
    if before is not None:
        left = left.join(before.select("node", F.col("bound").alias("b")), "node").withColumn("bound", F.col("bound") + F.col("b"))
    return met, staged(left.filter(F.col("bound") > math.log(1 - RECALL)).select("node", "bound"), f"deep-{batch}")


def _rest(batches: list[tuple[DataFrame, DataFrame, DataFrame]], refuted: DataFrame, asked: DataFrame, links: DataFrame,
          reps: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Links across groups among the pairs that forests left out, in nodes where a refuted pair's ends are still apart."""
    comp = components(links.select(F.col("a").alias("src"), F.col("b").alias("dst")), "forest-components")
    label = lambda c: comp.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root"))
    ends = refuted.join(label("a"), "a", "left").join(label("b"), "b", "left")
    again = staged(ends.filter(F.coalesce("a_root", "a") != F.coalesce("b_root", "b")).select("path").distinct(), "forest-nodes")
    more = None
    for batch, (met, traits, _) in enumerate(batches):
        rows = met.join(again, "path", "left_semi").join(traits.drop("label"), "node").join(comp, "node", "left")
        p = _compare(rows.withColumn("label", F.coalesce("root", "node")).drop("root"), percent, f"other-pairs-{batch}", every=True)
        more = p if more is None else more.unionByName(p)
    new = staged(more.select("a", "b").distinct().join(asked, ["a", "b"], "left_anti"), "other-pairs")
    return _confirmed(new, reps, docs, size, percent, "other-links")


def near_duplicates(docs: DataFrame, shingle_words: int = 2, percent: int = 80, trees: int = TREES) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept, and h (hash of its text), root (number of its group).

    Documents whose shingle sets reach a Jaccard similarity of ``percent``
    are linked; ``component_id`` is the smallest doc_id reachable and
    ``kept`` marks it.  Texts that are NULL or without words have an empty
    set and link with nothing.  Repeated rows give repeated rows; rows that
    share a doc_id but not the text are judged by their own text.  A NULL
    doc_id counts as the greatest: it names a component only if all ids of the
    component are NULL.
    """
    docs = docs.select("doc_id", "text")
    sets = staged(_sets(docs, shingle_words, full=False), "shingle-sketches")
    some = sets.filter("n > 0")
    # classes of equal sets, numbered in the order of their smallest doc_id
    no_id = F.col("doc_id").isNull().alias("no_id")
    classes = some.groupBy("d1", "d2").agg(F.min(F.struct(no_id, "doc_id", "n", "sketch", "bits")).alias("x")).select("d1", "d2", "x.*")
    reps = staged(
        classes.orderBy("no_id", "doc_id", "d1", "d2").drop("no_id").select("*", _sig().alias("sig"), F.monotonically_increasing_id().alias("node")),
        "shingle-classes")

    early = _confirmed(staged(_stars(reps, percent), "star-pairs"), reps, docs, shingle_words, percent, "star-links")
    comp = components(early.select(F.col("a").alias("src"), F.col("b").alias("dst")), "star-components")
    base = staged(
        reps.join(comp, "node", "left").select("node", F.coalesce("root", "node").alias("label"), "n", "sig",
                                               "bits", "sketch"), "class-labels")

    batch, left, batches = 0, None, []  # of each batch the nodes to compare, the traits of their members, the pairs
    traits = base
    while batch == 0 or left is not None and not left.isEmpty():
        if batch:
            fresh = _read_again(left, reps, docs, shingle_words, f"batch-{batch}", batch)
            traits = staged(base.select("node", "label", "n", "bits").join(
                fresh.select("node", "sketch", _sig().alias("sig")), "node"), f"batch-{batch}-labels")
        met, left = _trees(traits, percent, trees, batch, left)
        if met is not None:
            met, traits = staged(met, f"met-{batch}"), traits.drop("sketch")
            batches.append((met, traits, _compare(met.join(traits, "node"), percent, f"leaf-pairs-{batch}")))
        batch += 1
    links, pairs = early, None
    for _, _, p in batches:
        pairs = p if pairs is None else pairs.unionByName(p)
    if pairs is not None:
        asked = staged(pairs.select("a", "b").distinct(), "tree-pairs")
        good = _confirmed(asked, reps, docs, shingle_words, percent, "tree-links")
        links = links.unionByName(good)
        refuted = staged(pairs.filter("path is not null").join(good, ["a", "b"], "left_anti"), "refuted-pairs")
        if not refuted.isEmpty():
            links = links.unionByName(_rest(batches, refuted, asked, links, reps, docs, shingle_words, percent))
    final = components(links.select(F.col("a").alias("src"), F.col("b").alias("dst")), "shingle-components")
    head = reps.select(F.col("node").alias("root"), F.col("doc_id").alias("component_id"))
    known = reps.select("node", "d1", "d2").join(final, "node", "left").withColumn("root", F.coalesce("root", "node")) \
        .join(head, "root").select("d1", "d2", "component_id", "root")
    out = sets.join(known, ["d1", "d2"], "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                      F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "h", "root")


def keep_one(docs: DataFrame, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each group of near-duplicates: the smallest doc_id (NULL last), then the text's hash.

    Documents without words stay.  Of rows that share doc_id and text one
    stays.  Columns of any name are kept as they are.
    """
    found = near_duplicates(docs, shingle_words, percent)
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("h"))
    best = found.filter("root is not null").groupBy("root").agg(F.min_by(F.struct("doc_id", "h"), order).alias("k")).select("k.*")
    stay = staged(best.unionByName(found.filter("root is null").select("doc_id", "h")).distinct(), "near-duplicates-kept")
    rows = docs.select(F.struct("*").alias("row"), "doc_id", F.xxhash64("text").alias("h"))
    twice = staged(rows.groupBy("doc_id", "h").agg(F.count(F.lit(1)).alias("m")).filter("m > 1"), "repeated-rows")
    same = lambda a, b: F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.h") == F.col(f"{b}.h"))
    kept = rows.alias("r").join(stay.alias("s"), same("r", "s"), "left_semi")
    if not twice.isEmpty():
        once = kept.alias("r").join(twice.alias("t"), same("r", "t"), "left_anti")
        again = kept.alias("r").join(twice.alias("t"), same("r", "t"), "left_semi").dropDuplicates(["doc_id", "h"])
        kept = once.unionByName(again)
    return kept.select("row.*")

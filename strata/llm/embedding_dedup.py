"""Embedding near-duplicates by random-hyperplane sign hashing.

Equal vectors form one class.  In each of several tables a class falls into
the bucket of its signs against random hyperplanes; buckets above a block
size are cut into blocks that are all compared with each other, so no bucket
is capped.  Inside a block cosines are exact; it returns link counts and a
spanning forest per vector, never pairs.  Components are found distributed.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import components, staged

BUCKET = 128  # rows of an average bucket; sets the number of signs with the number of vectors
BLOCK = 256  # rows of a bucket that are compared with each other as one block
RECALL = 0.9995  # chance that a pair at the threshold meets in at least one table


def layout(n: int, threshold: float, recall: float = RECALL) -> tuple[int, int]:
    """(signs per table, tables): buckets hold about ``BUCKET`` rows of ``n``; tables reach ``recall``."""
    signs = max(2, math.ceil(math.log2(max(n, 1) / BUCKET))) if n > BUCKET else 2
    meet = (1 - math.acos(threshold) / math.pi) ** signs
    return min(signs, 60), max(1, math.ceil(math.log(1 - recall) / math.log(1 - meet)))


@functools.lru_cache(maxsize=8)
def hyperplanes(dim: int, n: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, n))


def unit_rows(col: pa.ListArray) -> list[np.ndarray]:
    """Unit vectors in double precision (scaled first, so that no square overflows)."""
    out = []
    for x in col.to_pylist():
        v = np.asarray(x, np.float64)
        v = v / np.abs(v).max()
        out.append(v / np.sqrt((v * v).sum()))
    return out


def keys_of(units: list[np.ndarray], signs: int, tables: int, seed: int) -> np.ndarray:
    """Bucket number of every vector in every table."""
    out = np.empty((len(units), tables), np.int64)
    by_dim: dict[int, list[int]] = {}
    for i, u in enumerate(units):
        by_dim.setdefault(len(u), []).append(i)
    weight = 1 << np.arange(signs, dtype=np.int64)
    for dim, at in by_dim.items():
        s = np.stack([units[i] for i in at]) @ hyperplanes(dim, signs * tables, seed) >= 0
        out[at] = s.reshape(len(at), tables, signs) @ weight * 100_003 + dim  # unequal lengths never meet
    return out


def usable(v: str = "v") -> F.Column:
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(v, lambda x: x != 0)
    return F.coalesce(F.col(v).isNotNull() & ~bad & some, F.lit(False))


def _block_links(table: pa.Table, threshold: float, signs: int, tables: int, seed: int) -> pa.Table:
    """Links inside one block: rep, links (sizes of linked classes met here first) and root of its part."""
    t = table.column("t")[0].as_py()
    side = table.column("i").to_numpy(), table.column("chunk").to_numpy()
    j = table.column("j")[0].as_py()
    rep, size = table.column("rep").to_numpy(), table.column("size").to_numpy()
    units = unit_rows(table.column("v").combine_chunks())
    x = np.stack(units)
    cos = x @ x.T
    link = cos >= threshold
    np.fill_diagonal(link, False)
    i = side[0][0]
    if i != j:  # two blocks: only pairs across; pairs within have their own block
        link &= (side[1][:, None] == i) & (side[1][None, :] == j) | (side[1][:, None] == j) & (side[1][None, :] == i)
    a, b = np.nonzero(link)
    links, root = np.zeros(len(rep), np.int64), rep.copy()
    if len(a):
        keys = keys_of(units, signs, tables, seed)[:, :t]
        first = ~(keys[a] == keys[b]).any(1)  # a pair counts in the first table where it meets
        np.add.at(links, a[first], size[b[first]])
        while True:
            low = root.copy()
            np.minimum.at(low, a, root[b])
            if (low == root).all():
                break
            root = low
    use = link.any(1)
    return pa.table({"rep": rep[use], "links": links[use], "root": root[use]})


def near_duplicates(df: DataFrame, threshold: float = 0.95, seed: int = 17, key: str = "vec_id",
                    vec: str = "embedding") -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Two vectors link when their cosine, in double precision, reaches
    ``threshold``.  ``n_links`` counts all other vectors linked directly,
    copies included; ``component_id`` is the smallest id reachable; ``kept``
    marks it.  NULL, empty and zero vectors and those with NULL or non-finite
    components link with nothing; vectors of unequal length never link.  Rows
    that repeat an id count as one vector, the smallest; a NULL id links with
    nothing and gives a row of its own id (NULL).
    """
    spark = df.sparkSession
    d = df.select(F.col(key).alias("vec_id"), F.col(vec).alias("v"))
    rows = staged(d.groupBy("vec_id").agg(F.min("v").alias("v")), "vectors")
    good = rows.filter(usable() & F.col("vec_id").isNotNull())
    reps = staged(good.groupBy("v").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("size")), "vector-classes")
    signs, tables = layout(reps.count(), threshold)

    def place(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 1024):
                part = b.slice(lo, 1024)
                if not part.num_rows:
                    continue
                keys = keys_of(unit_rows(part.column(0)), signs, tables, seed)
                at = np.repeat(np.arange(part.num_rows), tables)
                row = part.take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [*row.columns, pa.array(np.tile(np.arange(tables, dtype=np.int32), part.num_rows)),
                     pa.array(keys.reshape(-1))], ["v", "rep", "size", "t", "bucket"])

    kind = reps.schema["v"].dataType.simpleString()
    id_kind = reps.schema["rep"].dataType.simpleString()
    placed = reps.select("v", "rep", "size").mapInArrow(place, f"v {kind}, rep {id_kind}, size bigint, t int, bucket bigint")
    sizes = staged(placed.groupBy("t", "bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "vector-buckets")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    chunk = F.pmod(F.xxhash64("rep"), F.col("c")).cast("int")
    spread = (
        placed.join(sizes.withColumn("c", blocks).drop("n"), ["t", "bucket"]).withColumn("chunk", chunk)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("c") - 1)))
        .select("t", "bucket", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"),
                "chunk", "rep", "size", "v")
    )
    found = staged(
        spread.groupBy("t", "bucket", "i", "j").applyInArrow(
            lambda x: _block_links(x, threshold, signs, tables, seed), f"rep {id_kind}, links bigint, root {id_kind}"),
        "vector-links")
    comp = components(found.select(F.col("rep").alias("src"), F.col("root").alias("dst")), "vector-components")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    state = (
        reps.join(links, "rep", "left").join(comp.withColumnRenamed("node", "rep"), "rep", "left")
        .select("v", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                F.coalesce("root", "rep").alias("component_id"))
    )
    linked = good.join(state, "v").select("vec_id", "n_links", "component_id")
    rest = rows.filter(~usable() | F.col("vec_id").isNull()).select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(rest).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))

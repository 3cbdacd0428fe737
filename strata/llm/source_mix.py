"""Mixing sources to target weights by Sainte-Laguë apportionment.

The mix is counted in equal blocks of words.  Sources get blocks by highest
quotients of their targets; each source's blocks are apportioned to its shards
the same way by shard size.  In a shard documents lie in a seeded order and
seeded blocks of that word sequence are taken, whole passes first.  Only
DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import WORD, staged

BLOCK_WORDS = 64  # words of a block
SHARD_DOCS = 400  # documents of an average shard, which a seeded order is made over
REPEATS = 3  # a document is taken at most so many times its size


def word_count(text: Column) -> Column:
    """Number of words (maximal runs of anything but ASCII white space); NULL text: 0."""
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))), F.lit(0)).cast("bigint")


def code_point_rank(df: DataFrame, col: str, name: str) -> DataFrame:
    """``df`` with ``pos``: 0-based position by ``col``, NULL last, without a one-task sort.

    Rows are sorted in ranges and written; a range's offset is the number of
    rows before it (one row per range).
    """
    s = staged(df.orderBy(F.asc_nulls_last(col)).withColumn("_m", F.monotonically_increasing_id()), name)
    part = F.shiftright(F.col("_m"), 33)
    counts = s.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("_p", (F.sum("_n").over(Window.orderBy("_p")) - F.col("_n")).alias("_o"))
    return s.withColumn("_p", part).join(before, "_p").withColumn(
        "pos", F.col("_o") + F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))).drop("_m", "_p", "_o")


def targets(sources: DataFrame, rounds: int = 200) -> DataFrame:
    """Adds ``target`` to (source, source_size, weight): weight's share of all words, at most REPEATS sizes.

    The excess of capped sources is shared by weight among the others until
    none is above.  Each round is one small aggregate; a round that caps no
    further source ends it.
    """
    cap = F.col("source_size") * F.lit(float(REPEATS))
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    per, held = 0.0, -1
    for _ in range(rounds):
        over = (F.col("weight") * F.lit(per) >= cap) if held >= 0 else F.lit(False)
        r = sources.agg(F.sum(F.when(over, cap).otherwise(0.0)), F.sum(F.when(over, 0).otherwise(F.col("weight"))),
                        F.sum(over.cast("bigint"))).first()
        if r[2] is None or not r[1] or r[2] == held:
            break
        held, per = r[2], (total - (r[0] or 0.0)) / r[1]
    return sources.withColumn("target", F.least(F.col("weight") * F.lit(per), cap))


def sainte_lague(parts: DataFrame, group: list[str], claim: str, seats: str, cap: str, key: str) -> DataFrame:
    """Adds ``quota``: ``seats`` of a group given to its parts by the highest quotients claim / (2 k + 1).

    Every part first gets the seats that the method gives for certain (a
    divisor just too large); only the few seats left are ranked quotient by
    quotient, ties by ``key``.  No part gets more than ``cap``.
    """
    g = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(1))
    p = parts.withColumn("_all", F.sum(claim).over(g)).withColumn("_parts", F.count(F.lit(1)).over(g))
    sure_n = F.col(seats) - F.col("_parts") / 2
    sure = F.when(sure_n > 0, F.floor(F.col(claim) * sure_n / F.col("_all") + F.lit(0.5))).otherwise(0)
    most = F.floor(F.col(claim) * (F.col(seats) + F.col("_parts") / 2) / F.col("_all") + F.lit(0.5)) + 1
    p = p.withColumns({
        "_sure": F.when(F.col("_all") > 0, F.least(sure, F.col(cap), F.col(seats))).otherwise(0).cast("bigint"),
        "_most": F.when(F.col("_all") > 0, F.least(most, F.col(cap), F.col(seats))).otherwise(0).cast("bigint")})
    p = p.withColumn("_left", F.col(seats) - F.sum("_sure").over(g))
    bids = (
        p.filter((F.col("_most") > F.col("_sure")) & (F.col("_left") > 0))
        .select(*group, key, claim, "_left", F.explode(F.sequence(F.col("_sure"), F.col("_most") - 1)).alias("_k"))
        .withColumn("_q", F.col(claim) / (2 * F.col("_k") + 1))
    )
    bw = (Window.partitionBy(*group) if group else Window.partitionBy(F.lit(1))).orderBy(
        F.desc("_q"), F.asc_nulls_last(key), F.asc("_k"))
    won = bids.withColumn("_r", F.row_number().over(bw)).filter(F.col("_r") <= F.col("_left")) \
        .groupBy(*group, key).agg(F.count(F.lit(1)).alias("_more"))
    on = F.lit(True)
    a, b = p.alias("a"), won.alias("b")
    for c in [*group, key]:
        on = on & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    keep = [f"a.{c}" for c in parts.columns]
    return a.join(b, on, "left").select(*keep, (F.col("a._sure") + F.coalesce("b._more", F.lit(0))).alias("quota"))


def mix(docs: DataFrame, seed: int = 11, block_words: int = BLOCK_WORDS, carry: bool = False) -> DataFrame:
    """One row per document: doc_id, size, source, source_size, target, taken, and what is taken.

    That is ``passes`` whole copies, its first ``ahead`` words once more, and
    ``again`` words after its first ``skip``.  With ``carry`` the whole input
    row comes along as ``row``, whatever its columns are called.

    Sources in code point order, NULL last, weigh 1, 2, 3, repeating.  Texts
    that are NULL or without words have size 0 and nothing is taken from
    them; a source without words has target 0.  Repeated rows are documents
    of their own.  The choice depends on doc_id, text and seed only; rows that
    share an id but not the text fall into different shards.
    """
    spread = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"))
    size = word_count(F.col("text")).alias("size")
    d = staged(docs.select("doc_id", "source", size, spread.alias("h")), "mix-sizes")
    shards = F.lit(max(1, -(-d.count() // SHARD_DOCS)))
    d = d.withColumn("shard", F.pmod("h", shards))
    whole = d
    if carry:
        whole = docs.select("doc_id", "source", size, spread.alias("h"), F.struct("*").alias("row")).withColumn("shard", F.pmod("h", shards))
    cells = staged(d.groupBy("source", "shard").agg(F.sum("size").alias("cell")), "mix-cells")
    sources = cells.groupBy("source").agg(F.sum("cell").alias("source_size"))
    ranked = staged(code_point_rank(sources, "source", "mix-order").withColumn("weight", F.col("pos") % 3 + 1).drop("pos"),
                    "mix-sources")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    goal = targets(ranked).withColumns({
        "seats": F.lit(-(-total // block_words)).cast("bigint"),
        "cap": F.ceil(F.col("source_size") * REPEATS / block_words)})
    goal = sainte_lague(goal, [], "target", "seats", "cap", "source").withColumnRenamed("quota", "blocks")
    goal = staged(goal.select("source", "source_size", "target", "blocks"), "mix-blocks")
    c, g = cells.alias("c"), goal.alias("g")
    cell = c.join(g, F.col("c.source").eqNullSafe(F.col("g.source"))).select(
        "c.source", "c.shard", "c.cell", "g.source_size", "g.target", "g.blocks",
        F.ceil(F.col("c.cell") * REPEATS / block_words).alias("cap"))
    cell = sainte_lague(cell, ["source"], "cell", "blocks", "cap", "shard")
    # words to take in a cell; a source never takes more than its target
    words = F.least(F.col("quota") * block_words, F.col("cell") * REPEATS)
    cell = staged(cell.select("source", "shard", "cell", "source_size", "target", words.alias("words")), "mix-quotas")
    place = Window.partitionBy("source", "shard").orderBy("h", "doc_id", "size")
    lay = whole.withColumn("start", F.sum("size").over(place.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    x, y = lay.alias("x"), cell.alias("y")
    on = F.col("x.source").eqNullSafe(F.col("y.source")) & (F.col("x.shard") == F.col("y.shard"))
    blocks = F.greatest(F.ceil(F.col("y.cell") / block_words), F.lit(1))
    turn = F.pmod(F.xxhash64(F.lit(seed), "x.source", "x.shard"), blocks) * block_words  # the seeded first block
    out = x.join(y, on).select(
        "x.doc_id", "x.size", "x.source", *(["x.row"] if carry else []), "x.start", "y.cell", "y.source_size", "y.target",
        "y.words", turn.alias("turn"))
    cell, size = F.greatest(F.col("cell"), F.lit(1)), F.col("size")
    # whole passes of the shard, then the run of blocks from the seeded place on, going round at the shard's end
    out = out.withColumn("passes", F.floor(F.col("words") / cell)).withColumns({
        "rest": F.col("words") - F.col("passes") * F.col("cell"),
        "skip": F.col("cell") - F.pmod(F.col("start") - F.col("turn"), cell)})  # words from its first to the seeded place
    run_left = F.col("rest") - (F.col("cell") - F.col("skip"))
    out = out.withColumns({
        "ahead": F.greatest(F.lit(0), F.least(size, F.col("skip"), run_left)),
        "again": F.greatest(F.lit(0), F.least(size - F.col("skip"), F.col("rest")))})
    taken = F.when(size > 0, F.col("passes") * size + F.col("ahead") + F.col("again")).otherwise(0).cast("bigint")
    return out.withColumn("taken", taken).drop("start", "cell", "words", "turn", "rest")


def mixture(docs: DataFrame, seed: int = 11, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix itself: a row of ``docs`` for every copy taken, its text cut to the words taken; n_chars follows the text.

    Documents of which nothing is taken are not in it.
    """
    m = mix(docs, seed, block_words, carry=True)
    piece = lambda a, n: F.struct(a.cast("bigint").alias("a"), n.cast("bigint").alias("n"))
    parts = F.concat(
        F.array_repeat(piece(F.lit(0), F.col("size")), F.col("passes").cast("int")),
        F.array(piece(F.lit(0), F.col("ahead")), piece(F.col("skip"), F.col("again"))))
    rows = m.filter("taken > 0").select("row", "size", F.explode(F.filter(parts, lambda p: p["n"] > 0)).alias("p"))
    words = F.regexp_extract_all("row.text", F.lit(WORD + r"[\x20\x09-\x0D]*"), F.lit(0))
    cut = F.array_join(F.slice(words, (F.col("p.a") + 1).cast("int"), F.col("p.n").cast("int")), "")
    rows = rows.select("row", F.when(F.col("p.n") == F.col("size"), F.col("row.text")).otherwise(cut).alias("cut"))
    new = {"text": F.col("cut")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("cut").cast(docs.schema["n_chars"].dataType)
    return rows.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])

"""Helpers shared by the training-data operators: staged tables, components, word rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import shared_dir

#: Words of the contracts: maximal runs of anything but ASCII white space.
SPACE_CLASS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only (locale and Unicode case rules never apply)."""
    return F.translate(c, _UPPER, _LOWER)


def nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


def staged(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` to a fresh folder under the shared checkpoint folder and read it back.

    Cuts lineage: a lost executor re-reads files that all executors share.
    The schema is kept, so an empty result reads back too.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    schema = nullable(df.schema)
    w = df.write
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return spark.read.schema(schema).parquet(path)


#: 64-bit entries of a membership table.
MARKS = 1 << 14


def lookup(spark: SparkSession, rows: DataFrame, size: int, kind: str) -> Column:
    """``rows`` (at, value) with at < size as one array value, 0 where none (a scalar subquery)."""
    filled = spark.range(size).withColumnRenamed("id", "at").join(rows, "at", "left").select(
        "at", F.coalesce("value", F.lit(0)).cast(kind).alias("value"))
    return filled.agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "value"))), lambda x: x["value"]).alias("t")).scalar()


def marks(df: DataFrame, *cols: str) -> Column:
    """Whether the current row's ``cols`` may be among those of ``df``: never wrong when it says no.

    A table of fixed size: with many more rows than its bits it lets all
    pass, and what follows must still be exact.
    """
    bit = F.pmod(F.xxhash64(*cols), F.lit(MARKS * 64))
    words = df.select(bit.alias("b")).groupBy(F.floor(F.col("b") / 64).alias("at")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.col("b"), F.lit(64)).cast("int"))).alias("value"))
    table = lookup(df.sparkSession, staged(words, "marks"), MARKS, "bigint")
    word = F.element_at(table, (F.floor(bit / 64) + 1).cast("int"))
    return F.call_function("shiftright", word, F.pmod(bit, F.lit(64)).cast("int")).bitwiseAND(F.lit(1)) == 1


def components(edges: DataFrame, name: str = "components", max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected ``edges(src, dst)``: rows (node, root), root = smallest node.

    Alternating large-star / small-star passes: each pass points every
    neighbour of a node at the smallest node it sees.  A pass is a partial
    minimum per node plus a plain equi-join (hot hubs can be split by AQE);
    every round is written to the shared folder.  Nodes without an edge to
    another node are not returned.  NULL ends and self loops are ignored.
    """
    e = (
        edges.select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"))
        .filter(F.col("src").isNotNull() & F.col("dst").isNotNull() & (F.col("src") != F.col("dst")))
        .distinct()
    )
    e = staged(e, name)

    def mark(df: DataFrame) -> tuple:
        r = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return r[0], r[1]

    last = mark(e)
    if not last[0]:
        return e.select(F.col("b").alias("node"), F.col("a").alias("root"))
    for _ in range(max_rounds):
        # large star: neighbours above a node meet the smallest of its neighbourhood
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        star = (
            both.filter(F.col("v") > F.col("u")).join(low, "u")
            .select(F.col("m").alias("a"), F.col("v").alias("b"))
            .filter(F.col("a") != F.col("b")).distinct()
        )
        # small star: each node and its smaller neighbours meet the smallest of them
        low2 = star.groupBy("b").agg(F.min("a").alias("m"))
        hop = (
            star.join(low2, "b").select(F.col("m").alias("x"), F.explode(F.array("a", "b")).alias("y"))
            .filter(F.col("x") != F.col("y"))
        )
        e = staged(hop.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), name)
        now = mark(e)
        if now == last:
            return e.select(F.col("b").alias("node"), F.col("a").alias("root"))
        last = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")

"""The latest row per key, kept between runs: work follows the runs that are new or changed.

State is a table of latest rows in key buckets, one folder per generation.
A fold compares the runs that Bronze holds, each with the signature of its
files, with those the last generation has folded:

* a new run meets the state rows of the buckets its keys fall into;
* of a changed or missing run, the keys whose latest row came from it are
  ranked again over the whole history, and only those; a key that had a
  later row elsewhere is not affected;
* buckets without such keys are not read and not written.

Which runs are folded, and which buckets a generation wrote, is recorded after
its rows are complete: a fold that fails half-way is repeated from the
generation before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import runs
from strata.operators.dedupe import latest_by

GEN, BUCKET = "_gen", "_bucket"
BUCKETS = 32
FOLDED = "_folded"  # beside the generations: what each has folded


def _record(spark: SparkSession, state: str, gen: int, folded: dict[str, str], hit: list[int]) -> None:
    rows = [("run", k, v) for k, v in folded.items()] + [("bucket", str(b), "") for b in hit]
    spark.createDataFrame(rows, "kind string, name string, value string").coalesce(1).write.mode("overwrite").parquet(
        f"{state.rstrip('/')}/{FOLDED}/{gen:010d}")


def _records(spark: SparkSession, state: str) -> dict[int, str]:
    base = f"{state.rstrip('/')}/{FOLDED}"
    return {int(f.getPath().getParent().getName()): f.getPath().getParent().toString()
            for f in runs._glob(spark, f"{base}/*/_SUCCESS")}


def _known(spark: SparkSession, state: str) -> tuple[int, dict[str, str], dict[int, int]]:
    """(last complete generation, its runs and signatures, the last generation that wrote each bucket)."""
    at = _records(spark, state)
    if not at:
        return 0, {}, {}
    rows = spark.read.parquet(*at.values()).select("*", F.col("_metadata.file_path").alias("file")).collect()  # runs and buckets
    last, folded, buckets = max(at), {}, {}
    for r in rows:
        gen = int(r["file"].rsplit("/", 2)[-2])
        if r["kind"] == "bucket":
            buckets[int(r["name"])] = max(gen, buckets.get(int(r["name"]), 0))
        elif gen == last:
            folded[r["name"]] = r["value"]
    return last, folded, buckets


def _rows(spark: SparkSession, state: str, buckets: dict[int, int]) -> DataFrame | None:
    """State rows of the given (bucket: generation) units: their files only; None without state."""
    schema = runs.schema_of(spark, state)
    if schema is None:
        return None
    there = {(int(g), int(b)) for g, b in runs.listed(spark, state, GEN, BUCKET)}
    at = [runs.folder(state, **{GEN: f"{g:010d}", BUCKET: b}) for b, g in sorted(buckets.items()) if (g, b) in there]
    if not at:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", state).parquet(*at)


def read(spark: SparkSession, state: str) -> DataFrame:
    """The latest rows as of the last complete fold."""
    _, _, buckets = _known(spark, state)
    rows = _rows(spark, state, buckets)
    if rows is None:
        raise FileNotFoundError(f"no state at {state}")
    return rows.drop(GEN, BUCKET)


def fold(spark: SparkSession, bronze: str, state: str, key: str, order_col: str = "_ingest_ts", buckets: int = BUCKETS) -> DataFrame:
    """Bring ``state`` up to what ``bronze`` holds and return the latest row per ``key``.

    Equals a ranking of the whole history (``bronze.latest_from_bronze``):
    greatest ``order_col``, then the larger run id, then the row's content.  A
    NULL key is a key.  ``buckets`` belongs to the table and must not change.
    """
    now = {r: runs.signature(spark, bronze, r) for r in runs.labels(spark, bronze)}
    gen, folded, at = _known(spark, state)
    fresh = sorted(r for r in now if folded.get(r) != now[r])
    stale = sorted(r for r in folded if now.get(r) != folded[r])
    if not fresh and not stale and gen:
        return read(spark, state)
    place: Column = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    rows = runs.read_runs(spark, bronze, fresh)
    hit_of = rows.select(place.alias("b"))
    have = _rows(spark, state, at) if gen else None
    if stale:
        lost = have.filter(F.col(runs.RUN_ID).isin(stale)).select(F.col(key).alias("_lost")).distinct()
        hit_of = hit_of.union(lost.select(F.pmod(F.xxhash64("_lost"), F.lit(buckets)).cast("int").alias("b")))
        again = runs.read_runs(spark, bronze).join(lost, F.col(key).eqNullSafe(F.col("_lost")), "left_semi")
        rows = rows.unionByName(again)
    hit = sorted(r["b"] for r in hit_of.distinct().collect())  # at most the buckets
    if have is not None:
        kept = _rows(spark, state, {b: at[b] for b in hit if b in at}).drop(GEN, BUCKET)
        kept = kept.filter(~F.col(runs.RUN_ID).isin(stale)) if stale else kept
        rows = kept.unionByName(rows, allowMissingColumns=True)
    out = latest_by(rows, [key], [F.desc(order_col), F.desc(runs.RUN_ID)])
    runs.write_run(out.withColumn(BUCKET, place), state, f"{gen + 1:010d}", GEN, (BUCKET,))
    _record(spark, state, gen + 1, now, hit)
    return read(spark, state)

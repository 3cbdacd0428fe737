"""A type-2 table on disk whose run is one unit.

A run is the folder ``_as_of=<time>``.  Keys fall into hash buckets, and every
row carries a digest of its tracked columns.  A run compares keys and digests
of the open rows with those of the snapshot (three narrow columns, not rows),
and writes only the buckets that hold a changed or new key: all open rows of
the bucket, and the rows that the run closes, side by side::

    <path>/_as_of=<time>/_bucket=<n>/is_current=true|false/

The table at a time is, for every bucket, the open rows of the last run that
wrote it, and the closed rows of all runs so far.  A run reads only earlier
ones and replaces its own folder whole, so a corrected re-run gives what a
first run would have given.  Rows with a NULL key match nothing and are never
closed; they are appended in a bucket of their own.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import runs, scd2
from strata.operators.snapshots import AS_OF
from strata.sources.files import footer_rows

BUCKET, DIGEST = "_bucket", "_digest"
BUCKETS = 32  # of a table; its first run fixes them
NULL_KEYS = -1


@dataclass(frozen=True)
class Written:
    """What a run wrote: its rows, and the buckets among all."""

    rows: int
    buckets: tuple[int, ...]


def _any_null(keys: Sequence[str]) -> Column:
    return F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False))


def _placed(df: DataFrame, keys: Sequence[str], tracked: Sequence[str], types: dict, buckets: int) -> DataFrame:
    """Bucket of the key, and the digest of the tracked columns as the table types them, NULLs told apart."""
    typed = [F.col(c).cast(types.get(c, df.schema[c].dataType)) for c in tracked]
    return df.withColumns({
        BUCKET: F.when(_any_null(keys), F.lit(NULL_KEYS)).otherwise(F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")),
        DIGEST: F.xxhash64(*typed, *[c.isNull() for c in typed])})


def _units(spark: SparkSession, path: str, upto: str, itself: bool) -> tuple[dict[int, str], list[tuple[str, int]]]:
    """(the last run that wrote each bucket, all units with open NULL-key rows) up to a run, from the listing."""
    last, null = {}, []
    for label, bucket in runs.listed(spark, path, AS_OF, BUCKET):
        if label < upto or (itself and label == upto):
            if int(bucket) == NULL_KEYS:
                null.append((label, NULL_KEYS))
            else:
                last[int(bucket)] = max(label, last.get(int(bucket), label))
    return last, null


def _open_rows(spark: SparkSession, path: str, units: Sequence[tuple[str, int]]) -> DataFrame:
    """Open rows of (run, bucket) units: their files only."""
    schema = runs.schema_of(spark, path)
    there = {(a, int(b)) for a, b, c in runs.listed(spark, path, AS_OF, BUCKET, scd2.CURRENT) if c == "true"}
    at = [runs.folder(path, **{AS_OF: a, BUCKET: b, scd2.CURRENT: "true"}) for a, b in units if (a, b) in there]
    if not at:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*at)


def apply_run(
    snapshot: DataFrame, path: str, as_of: str, key: str | Sequence[str], tracked: Sequence[str] = scd2.TRACKED_COLUMNS,
    null_safe: bool = False, close_missing: bool = False, null_keys: str = "insert", buckets: int = BUCKETS,
    ts_type: str = "timestamp_ntz",
) -> Written:
    """Apply ``snapshot`` (one row per key) at ``as_of`` and write the run, replacing an earlier attempt whole.

    The rules are those of :func:`scd2.scd2_apply`.  A run before the last one
    raises: the later runs were made from what it held, and would have to be
    run again in order (delete their folders first).
    """
    spark, keys = snapshot.sparkSession, [key] if isinstance(key, str) else list(key)
    if null_keys not in ("insert", "reject"):
        raise ValueError("null_keys must be 'insert' or 'reject'")
    known = runs.labels(spark, path, AS_OF)
    if [x for x in known if x > as_of]:
        raise ValueError(f"runs after {as_of} at {path} were made from it")
    if null_keys == "reject":
        snapshot = snapshot.filter(~_any_null(keys))
    last, _ = _units(spark, path, as_of, itself=False)
    hidden = (AS_OF, BUCKET, DIGEST)
    if not [x for x in known if x < as_of]:
        nxt, types = scd2.scd2_init(snapshot, as_of, ts_type), {f.name: f.dataType for f in snapshot.schema.fields}
        out = _placed(nxt, keys, tracked, types, buckets)
        _store_buckets(spark, path, buckets)
    else:
        types = {f.name: f.dataType for f in runs.schema_of(spark, path).fields}
        buckets = _bucket_count(spark, path)
        inc = _placed(snapshot, keys, tracked, types, buckets)
        have = _open_rows(spark, path, [(a, b) for b, a in last.items()]).select(*keys, BUCKET, F.col(DIGEST).alias("_had"))
        want = inc.filter(F.col(BUCKET) != NULL_KEYS).select(*keys, F.col(BUCKET).alias("_to"), DIGEST)
        both = have.join(want, keys, "full_outer")
        moved = F.col("_had") != F.col(DIGEST)
        fresh, lost = F.col(BUCKET).isNull(), F.col("_to").isNull()
        touched = both.filter(F.coalesce(moved, F.lit(False)) | fresh | (lost & F.lit(close_missing)))
        hit = sorted(r[0] for r in touched.select(F.coalesce(BUCKET, "_to")).distinct().collect())  # at most the buckets
        table = _open_rows(spark, path, [(last[b], b) for b in hit if b in last]).drop(*hidden)
        use = inc.filter(F.col(BUCKET).isin([*hit, NULL_KEYS])).drop(*hidden)
        nxt = scd2.scd2_apply(table, use, keys, as_of, tracked, null_safe, close_missing, null_keys, ts_type)
        out = _placed(nxt, keys, tracked, types, buckets)
    n = runs.write_run(out, path, as_of, AS_OF, (BUCKET, scd2.CURRENT))
    return Written(n, tuple(int(b) for a, b in runs.listed(spark, path, AS_OF, BUCKET) if a == as_of))


def _store_buckets(spark: SparkSession, path: str, n: int) -> None:
    spark.createDataFrame([(str(n),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path.rstrip('/')}/_buckets")


def _bucket_count(spark: SparkSession, path: str) -> int:
    return int(spark.read.text(f"{path.rstrip('/')}/_buckets").first()[0])


def read(spark: SparkSession, path: str, as_of: str | None = None) -> DataFrame:
    """The whole table after run ``as_of`` (the last by default): open rows and all closed ones so far."""
    known = runs.labels(spark, path, AS_OF)
    upto = as_of if as_of is not None else (known[-1] if known else None)
    if upto is None or not [x for x in known if x <= upto]:
        raise FileNotFoundError(f"no table at {path}")
    closed = runs.read_runs(spark, path, [x for x in known if x <= upto], AS_OF).filter(~F.col(scd2.CURRENT))
    return current(spark, path, upto).unionByName(closed.drop(AS_OF, BUCKET, DIGEST))


def current(spark: SparkSession, path: str, as_of: str) -> DataFrame:
    """Only the open rows after run ``as_of``."""
    last, null = _units(spark, path, as_of, itself=True)
    return _open_rows(spark, path, [(a, b) for b, a in last.items()] + null).drop(AS_OF, BUCKET, DIGEST)


def row_count(spark: SparkSession, path: str, as_of: str) -> int:
    """Rows of the table after run ``as_of``, from the file footers."""
    last, null = _units(spark, path, as_of, itself=True)
    units = {(a, b) for b, a in last.items()} | set(null)
    total = 0
    for r in footer_rows(spark, path, (AS_OF, BUCKET, scd2.CURRENT)).collect():  # runs times buckets
        open_ = str(r[scd2.CURRENT]).lower() == "true"
        if r[AS_OF] <= as_of and (not open_ or (r[AS_OF], int(r[BUCKET])) in units):
            total += r["rows"]
    return total

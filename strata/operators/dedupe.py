"""Keep-latest and duplicate splitting.

``latest_by`` keeps rank 1 per key.  Written as ``row_number() ... = 1`` so
Catalyst inserts a partial ``WindowGroupLimit`` before the shuffle: each map
task forwards at most one row per key, so a key holding a third of all rows
does not land whole on one reducer.

``split_duplicates`` returns (clean, rejected).  It stages its input once
(a Parquet table in the shared folder) with a row id.  Clean is the rank-1
path over the staged rows; rejected is an anti join of the staged rows with
the winners' ids.  The files fix rows and ids and the order is total, so both
sides see the same winners whenever they run, and each input row lands in
exactly one of them.  The row id is unique, so the join spreads evenly
whatever the key distribution (also for a hot group of exact copies).
``session.staging`` frees the staged table once both sides are written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.columns import as_column
from strata.session import shared_dir

ROW_ID = "_row_id"
_SORTABLE_SKIP = ("array", "map", "struct", "binary", "variant")


def _sortable(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    out = []
    for f in df.schema.fields:
        if f.name in exclude:
            continue
        if f.dataType.typeName() in _SORTABLE_SKIP:
            continue
        out.append(f.name)
    return out


def total_order(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], tiebreak=None) -> list[Column]:
    """``order`` followed by a tiebreak that makes the ranking deterministic.

    Default tiebreak: the row id when present, otherwise every other sortable
    column ascending, so equal sort values never pick arbitrarily.
    """
    cols = [as_column(o) for o in order]
    if tiebreak is None:
        if ROW_ID in df.columns:
            tiebreak = [ROW_ID]
        else:
            named = {o for o in order if isinstance(o, str)}
            tiebreak = _sortable(df, list(keys) + list(named))
    return cols + [F.col(t).asc_nulls_last() if isinstance(t, str) else t for t in tiebreak]


def rank_within(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], name: str = "_rn", tiebreak=None) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*total_order(df, keys, order, tiebreak))
    return df.withColumn(name, F.row_number().over(w))


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], tiebreak=None) -> DataFrame:
    """One row per key: the first under ``order`` (e.g. ``[F.desc("_ingest_ts")]``).

    NULL keys form one group, as in a Spark window.
    """
    ranked = rank_within(df, keys, order, "_rn_latest", tiebreak)
    return ranked.filter(F.col("_rn_latest") == 1).drop("_rn_latest")


def stage(df: DataFrame, with_row_id: bool = True, name: str = "stage") -> DataFrame:
    """Write ``df`` once as Parquet in the shared checkpoint folder, with a row id.

    The ids are fixed by the committed files: every consumer reads the same
    rows and ids, also when an executor is lost and tasks re-run, and the
    lineage is cut (one computation of the input, unlike an RDD checkpoint
    which recomputes it for the write).
    """
    spark = df.sparkSession
    if with_row_id and ROW_ID not in df.columns:
        df = df.withColumn(ROW_ID, F.monotonically_increasing_id())
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def split_duplicates(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    reason: str,
    reject_columns: Sequence[str] | None = None,
    null_key_reason: str | None = None,
    tiebreak=None,
    staged: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Split ``df`` into (clean, rejected) by business key.

    clean: rank 1 per key under ``order`` (ties broken deterministically).
    rejected: every other row, with ``rejection_reason = reason``.
    ``null_key_reason`` (strict mode): rows with a NULL key go straight to
    rejected with that reason instead of competing as one NULL group.
    ``reject_columns`` selects the rejected layout (``rejection_reason`` is
    added if not listed).  Clean keeps the input columns.
    ``staged=True``: ``df`` is already a stored table carrying ``_row_id``
    so no second write is needed.

    Ties under ``order`` are broken by a hash of the row's content, so the same
    input picks the same winner on every run whatever the staging order; the
    row id only chooses among exact copies.
    """
    keep_cols = [c for c in df.columns if c != ROW_ID]
    base = df if staged else stage(df)
    if ROW_ID not in base.columns:
        raise ValueError("staged input must carry a row id column")
    if tiebreak is None:
        tiebreak = [F.xxhash64(*_sortable(base, [ROW_ID])).asc()]
    tb = list(tiebreak) + [ROW_ID]

    if null_key_reason is not None:
        any_null = F.lit(False)
        for k in keys:
            any_null = any_null | F.col(k).isNull()
        null_rows = base.filter(any_null).withColumn("rejection_reason", F.lit(null_key_reason))
        ranked_base = base.filter(~any_null)
    else:
        null_rows = None
        ranked_base = base

    won = latest_by(ranked_base, keys, order, tiebreak=tb)
    clean = won.select(*keep_cols)
    losers = ranked_base.join(won.select(ROW_ID), ROW_ID, "left_anti").withColumn("rejection_reason", F.lit(reason))
    if null_rows is not None:
        losers = losers.unionByName(null_rows)
    if reject_columns is None:
        reject_columns = keep_cols + ["rejection_reason"]
    elif "rejection_reason" not in reject_columns:
        reject_columns = list(reject_columns) + ["rejection_reason"]
    rejected = losers.select(*reject_columns)
    return clean, rejected

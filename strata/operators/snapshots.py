"""Versions of a table, one run folder each, and value-clustered rewrites.

Built on :mod:`strata.operators.runs`: a write replaces its own version only,
and a reader lists and opens the versions it names.  Versions sort as text
(an as-of time, or a zero-padded number).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import runs

AS_OF = "_as_of"


def write_partition(df: DataFrame, path: str, label, column: str = AS_OF, also: Sequence[str] = ()) -> int:
    """``df`` as the version ``label`` of ``path``, replacing it whole; returns the rows written."""
    return runs.write_run(df, path, label, column, also)


def latest_label(spark: SparkSession, path: str, before: str | None = None, column: str = AS_OF) -> str | None:
    """The greatest label, or the greatest below ``before``, from the listing; None without one."""
    found = [x for x in runs.labels(spark, path, column) if before is None or x < before]
    return found[-1] if found else None


def read_partition(spark: SparkSession, path: str, label: str | None = None, column: str = AS_OF) -> DataFrame:
    """Rows of one version (the greatest by default), without the label column; a missing version raises."""
    label = label if label is not None else latest_label(spark, path, column=column)
    if label is None:
        raise FileNotFoundError(f"no table at {path}")
    return runs.read_run(spark, path, label, column)


def compare_partitions(
    spark: SparkSession, path: str, predicate: str | Column, a: str, b: str, column: str = "version",
    labels: tuple[str, str] = ("now", "v0"), value_name: str = "active_count",
) -> DataFrame:
    """The same filtered count at two labels, stacked as (snapshot, count) rows.

    One scan of the two versions' files and one aggregate; both rows
    appear even when a count is zero.  A missing version raises.
    """
    missing = {str(a), str(b)} - set(runs.labels(spark, path, column))
    if missing:
        raise FileNotFoundError(f"no version {', '.join(sorted(missing))} at {path}")
    t = runs.read_runs(spark, path, sorted({str(a), str(b)}), column)
    pred = F.expr(predicate) if isinstance(predicate, str) else predicate
    agg = t.agg(F.count_if((F.col(column) == a) & pred).alias("_a"), F.count_if((F.col(column) == b) & pred).alias("_b"))
    rows = [F.struct(F.lit(name).alias("snapshot"), F.col(c).alias(value_name)) for name, c in zip(labels, ("_a", "_b"))]
    return agg.select(F.inline(F.array(*rows)))


def clustered(df: DataFrame, columns: list[str], target_bytes: int, row_bytes: int) -> DataFrame:
    """``df`` in value ranges of ``columns``, sorted inside each, about ``target_bytes`` a file.

    The number of ranges follows from the row count; a range is cut by all
    columns and the row's hash, so one hot value spreads over several files.
    """
    n = max(1, -(-df.count() * row_bytes // target_bytes))
    spread = F.xxhash64(*df.columns)
    return df.repartitionByRange(int(n), *columns, spread).sortWithinPartitions(*columns)

"""Bronze ingest: lineage stamp and run-partitioned, re-run-safe appends."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import typed_timestamp
from strata.operators import runs
from strata.operators.dedupe import latest_by
from strata.sources.files import footer_rows

LINEAGE_COLUMNS = ("_ingest_ts", "_source_file", "_run_id")


def stamp_lineage(
    df: DataFrame, run_id: str, ingest_ts, source_file: bool = True, ts_type: str = "timestamp_ntz"
) -> DataFrame:
    """Add ``_ingest_ts`` (the given time), ``_source_file`` (file of each row) and ``_run_id``.

    ``source_file`` needs a file-based DataFrame (``_metadata.file_path``);
    pass False for other inputs and the column is NULL.
    """
    src = F.col("_metadata.file_path") if source_file else F.lit(None).cast("string")
    return df.withColumns(
        {"_ingest_ts": typed_timestamp(ingest_ts, ts_type), "_source_file": src, "_run_id": F.lit(run_id)}
    )


def append_run(df: DataFrame, path: str, run_id: str) -> int:
    """Append-only history, one folder ``_run_id=<run>`` per run; returns the rows written.

    The run's folder is replaced whole, so re-running a run does not duplicate
    its rows, and a re-run without rows leaves none; other runs stay untouched.
    New columns are allowed: older runs read NULL for them (``read_bronze``).
    """
    return runs.write_run(df, path, run_id)


def ingest_bronze(df: DataFrame, run_id: str, ingest_ts, path: str | None = None, source_file: bool = True) -> DataFrame:
    """Stamp lineage and, when ``path`` is given, append the run to Bronze."""
    stamped = stamp_lineage(df, run_id, ingest_ts, source_file)
    if path is not None:
        append_run(stamped, path, run_id)
    return stamped


def read_bronze(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All runs; older runs read NULL for later columns.  Run ids are text ('001' stays '001').

    The table's stored schema (or ``schema``) is used, so no footer is read
    before the scan, however long the history.
    """
    if schema is None:
        return runs.read_runs(spark, path)
    fields = [T.StructField(f.name, T.StringType() if f.name == runs.RUN_ID else f.dataType) for f in schema.fields]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def runs_summary(bronze: DataFrame) -> DataFrame:
    """Rows per run, ordered by run id."""
    return bronze.groupBy("_run_id").agg(F.count(F.lit(1)).alias("rows")).orderBy("_run_id")


def stored_runs(spark: SparkSession, path: str) -> DataFrame:
    """Rows per run of a stored history, ordered by run id, from file footers.  A run without rows counts 0."""
    there = spark.createDataFrame([(x,) for x in runs.labels(spark, path)], "_run_id string")  # one row per run
    found = footer_rows(there.sparkSession, path, (runs.RUN_ID,)).collect()
    rows = spark.createDataFrame([(r[0], r["rows"]) for r in found], "_run_id string, rows bigint")
    return there.join(rows, "_run_id", "left").select("_run_id", F.coalesce("rows", F.lit(0)).alias("rows")).orderBy("_run_id")


def latest_from_bronze(bronze: DataFrame, key: str, order_col: str = "_ingest_ts") -> DataFrame:
    """Latest Bronze row per ``key``, ranked over the whole history.

    The answer depends only on what Bronze holds: a run that was appended but
    never processed, a corrected re-run of an earlier run and a run that
    arrives late all count.  Each map task forwards one row per key at most.
    Equal times: the larger run id, then the row's content.
    """
    return latest_by(bronze, [key], [F.desc(order_col), F.desc("_run_id")])

"""Run audit record: one row per run.

A run knows its counts from the writes themselves (``counted``: numbers that
``write_run`` observed, or file footers), so no table is read again for its
audit row.  ``table_counts`` counts DataFrames that were not written.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import typed_timestamp

# Fixed values that must equal the reference's for the same results.
AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("pipeline_name", T.StringType(), True),
        T.StructField("source_name", T.StringType(), True),
        T.StructField("load_type", T.StringType(), True),
        T.StructField("start_time", T.TimestampType(), True),
        T.StructField("end_time", T.TimestampType(), True),
        T.StructField("records_read", T.LongType(), True),
        T.StructField("records_inserted", T.LongType(), True),
        T.StructField("records_updated", T.LongType(), True),
        T.StructField("records_rejected", T.LongType(), True),
        T.StructField("status", T.StringType(), True),
        T.StructField("error_message", T.StringType(), True),
    ]
)
STATUS_OK, STATUS_PARTIAL = "Success", "PartialFailure"
PIPELINE_NAME, SOURCE_NAME, LOAD_TYPE = "pl_master_hr", "all_sources", "Full"


def table_counts(read: Mapping[str, DataFrame], rejected: Mapping[str, DataFrame]) -> DataFrame:
    """One row: ``records_read`` (sum over ``read``) and ``records_rejected``."""
    parts = []
    for name, df in read.items():
        parts.append(df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table"), F.lit("read").alias("kind"), "n"))
    for name, df in rejected.items():
        parts.append(df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table"), F.lit("rejected").alias("kind"), "n"))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.agg(
        F.coalesce(F.sum(F.when(F.col("kind") == "read", F.col("n"))), F.lit(0)).alias("records_read"),
        F.coalesce(F.sum(F.when(F.col("kind") == "rejected", F.col("n"))), F.lit(0)).alias("records_rejected"),
    )


def counted(spark: SparkSession, read: Mapping[str, int], rejected: Mapping[str, int]) -> DataFrame:
    """The one row of ``table_counts`` from known numbers; a table whose write failed is left out and counts 0."""
    return spark.createDataFrame([(sum(read.values()), sum(rejected.values()))], "records_read bigint, records_rejected bigint")


def audit_row(
    counts: DataFrame,
    run_id: str,
    start_time,
    end_time,
    failed_steps: Sequence[str] = (),
    skipped_steps: Sequence[str] = (),
    pipeline_name: str = PIPELINE_NAME,
    source_name: str = SOURCE_NAME,
    load_type: str = LOAD_TYPE,
    records_updated: int = 0,
    ts_type: str = "timestamp_ntz",
) -> DataFrame:
    """The 12-column audit row built on ``table_counts`` output.

    ``records_inserted`` equals ``records_read`` as in the reference; the
    status is PartialFailure and the message lists failed steps when any
    failed, then those skipped because of them.
    """
    ok = len(failed_steps) == 0
    msg = None if ok else "Failed notebooks: " + ", ".join(failed_steps)
    if msg and skipped_steps:
        msg += "; skipped: " + ", ".join(skipped_steps)
    return counts.select(
        F.lit(run_id).alias("run_id"),
        F.lit(pipeline_name).alias("pipeline_name"),
        F.lit(source_name).alias("source_name"),
        F.lit(load_type).alias("load_type"),
        typed_timestamp(start_time, ts_type).alias("start_time"),
        typed_timestamp(end_time, ts_type).alias("end_time"),
        F.col("records_read").cast("bigint").alias("records_read"),
        F.col("records_read").cast("bigint").alias("records_inserted"),
        F.lit(records_updated).cast("bigint").alias("records_updated"),
        F.col("records_rejected").cast("bigint").alias("records_rejected"),
        F.lit(STATUS_OK if ok else STATUS_PARTIAL).alias("status"),
        F.lit(msg).cast("string").alias("error_message"),
    )


def audit_record(spark: SparkSession, values: Sequence) -> DataFrame:
    """A literal audit row from Python values with the fixed schema."""
    return spark.createDataFrame([tuple(values)], AUDIT_SCHEMA)


def narrow_counts(audit: DataFrame) -> DataFrame:
    """The audit row with INT counts, as the SQL audit table has them; a count that does not fit raises."""
    counts = [f.name for f in audit.schema.fields if f.name.startswith("records_")]
    fits = lambda c: F.when(F.abs(c) <= 2147483647, c.cast("int")).otherwise(
        F.raise_error(F.concat(F.lit("count too large for the audit table: "), c.cast("string"))).cast("int"))
    return audit.withColumns({c: fits(F.col(c)) for c in counts})

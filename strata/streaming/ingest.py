"""Incremental Bronze ingest of landed CSV files with Structured Streaming.

The file source remembers, in its checkpoint, which files it has read, so
each landed file is ingested exactly once however often the job runs
(``trigger(availableNow=True)``: read what is there, then stop).  Each
micro-batch is written by ``foreachBatch`` into its own folder
``_batch=<epoch>``, replaced whole, so a batch replayed after
a failure replaces its own output, also when the restart has another run id.
One checkpoint belongs to one Bronze folder; batch numbers are the
checkpoint's.  A replayed batch carries the run id of the run that completed it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from strata.functions.columns import typed_timestamp
from strata.operators.runs import write_run
from strata.sources.files import CSV_DIALECT, unspelled


def _writer(bronze_path: str):
    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        write_run(batch, bronze_path, epoch_id, "_batch")  # a replayed batch replaces its output, also by nothing

    return write_batch


def start_csv_ingest(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType | str,
    bronze_path: str,
    checkpoint_location: str,
    run_id: str,
    ingest_ts,
    max_files_per_trigger: int | None = None,
    landed: bool = True,
) -> StreamingQuery:
    """Start an availableNow stream from ``source_dir`` (recursively) into Bronze.

    Rows get ``_ingest_ts`` (the given time), ``_source_file`` and ``_run_id``.
    ``landed``: the files are those of ``land_csv``, one record a line; pass
    False for foreign files, which may hold quoted line breaks.
    """
    reader = (
        spark.readStream.schema(schema)
        .options(**CSV_DIALECT)
        .option("recursiveFileLookup", "true").option("multiLine", str(not landed).lower())
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    rows = reader.csv(source_dir)
    stream = (unspelled(rows) if landed else rows).withColumns(
        {
            "_ingest_ts": typed_timestamp(ingest_ts),
            "_source_file": F.col("_metadata.file_path"),
            "_run_id": F.lit(run_id),
        }
    )
    return (
        stream.writeStream.foreachBatch(_writer(bronze_path))
        .option("checkpointLocation", checkpoint_location)
        .trigger(availableNow=True)
        .start()
    )


def ingest_available(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType | str,
    bronze_path: str,
    checkpoint_location: str,
    run_id: str,
    ingest_ts,
    max_files_per_trigger: int | None = None,
    landed: bool = True,
) -> None:
    """Run ``start_csv_ingest`` to completion (all files present now)."""
    q = start_csv_ingest(
        spark, source_dir, schema, bronze_path, checkpoint_location, run_id, ingest_ts, max_files_per_trigger, landed
    )
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()

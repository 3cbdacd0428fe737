"""Tables kept as one folder per run: replaced whole, found by listing, read without touching other runs.

``<path>/<column>=<label>/`` holds one run.  A write replaces that folder
statically, sub-partitions included, so a corrected run leaves nothing of its
first attempt and an empty run leaves nothing at all.  Labels come from the
folder listing, and the schema of the table is stored beside the runs, so
neither finding a run nor reading one opens the files of another.

One writer at a time per table.  Labels are text and sort as text.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUN_ID = "_run_id"
SCHEMA = "_schema"  # folder of the stored schema; readers of the table skip it
# Characters that a partition folder's name spells as %XX.
ESCAPED = "\"#%'*/:=?\\\x7f{[]^"


def name_of(column: str, label) -> str:
    """The folder of a partition value, as Spark names it."""
    text = "".join(f"%{ord(c):02X}" if c in ESCAPED or ord(c) < 32 else c for c in str(label))
    return f"{column}={text or '__HIVE_DEFAULT_PARTITION__'}"


def folder(path: str, **values) -> str:
    return "/".join([path.rstrip("/"), *(name_of(k, v) for k, v in values.items())])


def _glob(spark: SparkSession, pattern: str) -> list:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at)
    return list(found) if found is not None else []


def listed(spark: SparkSession, path: str, *columns: str) -> list[tuple[str, ...]]:
    """The values of the partition folders ``columns`` (nested in that order), from the listing alone, sorted."""
    out = []
    for status in _glob(spark, "/".join([path.rstrip("/"), *(f"{c}=*" for c in columns)])):
        parts = status.getPath().toUri().getPath().split("/")[-len(columns):]
        out.append(tuple(unquote(p.split("=", 1)[1]) for p in parts))
    return sorted(out)


def labels(spark: SparkSession, path: str, column: str = RUN_ID) -> list[str]:
    return [x[0] for x in listed(spark, path, column)]


def signature(spark: SparkSession, path: str, label, column: str = RUN_ID) -> str:
    """What a run's files are (names and sizes): changes whenever the run is written again."""
    files = _glob(spark, folder(path, **{column: label}) + "/*")
    names = sorted((f.getPath().getName(), f.getLen()) for f in files if not f.getPath().getName().startswith(("_", ".")))
    return hashlib.sha256(repr(names).encode()).hexdigest()


def schema_of(spark: SparkSession, path: str) -> T.StructType | None:
    """The stored schema; merged from the files' footers where none is stored; None without a table."""
    if _glob(spark, f"{path.rstrip('/')}/{SCHEMA}"):
        return T.StructType.fromJson(json.loads(spark.read.text(f"{path.rstrip('/')}/{SCHEMA}", wholetext=True).first()[0]))
    if not _glob(spark, f"{path.rstrip('/')}/*=*"):
        return None
    return spark.read.option("mergeSchema", "true").parquet(path).schema


def _merged(old: T.StructType | None, new: T.StructType, partitions: dict[str, T.DataType]) -> T.StructType:
    """Columns of ``old``, then those only ``new`` has, nullable; then the partition columns.

    A column whose type has changed must be wider or equal in one of the two
    (as Parquet readers widen); anything else raises here, before the write.
    """
    fields: dict[str, T.StructField] = {}
    for f in [*(old.fields if old else []), *new.fields]:
        if f.name in partitions:
            continue
        kind = f.dataType
        if f.name in fields and fields[f.name].dataType != kind:
            had = fields[f.name].dataType
            wide = {T.ByteType(): 1, T.ShortType(): 2, T.IntegerType(): 3, T.LongType(): 4}
            real = {T.FloatType(): 1, T.DoubleType(): 2}
            rank = wide if had in wide and kind in wide else real if had in real and kind in real else None
            if rank is None:
                raise ValueError(f"column {f.name}: {had.simpleString()} in the table, {kind.simpleString()} in this run")
            kind = max(had, kind, key=rank.__getitem__)
        fields[f.name] = T.StructField(f.name, kind, True)
    return T.StructType([*fields.values(), *(T.StructField(k, v, True) for k, v in partitions.items())])


def _store_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    one = spark.createDataFrame([(schema.json(),)], "value string").coalesce(1)
    one.write.mode("overwrite").text(f"{path.rstrip('/')}/{SCHEMA}")


def _reads_from(df: DataFrame, target: str) -> bool:
    own = urlparse(target).path.rstrip("/") + "/"
    return any(unquote(urlparse(f).path).startswith(own) for f in df.inputFiles())


def write_run(df: DataFrame, path: str, label, column: str = RUN_ID, also: Sequence[str] = ()) -> int:
    """Replace the run ``label`` of the table at ``path`` by ``df``; returns the rows written.

    The count is observed in the write itself, nothing is read again.  ``also``
    are further partition columns inside the run.  Other runs stay as they
    are; columns new to the table are added to its stored schema, and older
    runs read NULL for them.  An empty ``df`` leaves the run there, without
    rows.  A ``df`` that reads the run it would replace raises.
    """
    spark, target = df.sparkSession, folder(path, **{column: label})
    if _reads_from(df, target):
        raise ValueError(f"refusing to replace {target}: the DataFrame reads from it")
    out = df.drop(column)
    parts = {column: T.StringType()} | {c: out.schema[c].dataType for c in also}
    old = schema_of(spark, path)
    merged = _merged(old, out.schema, parts)
    if old != merged:
        _store_schema(spark, path, merged)
    seen = Observation()
    if also:
        out = out.hint("rebalance", *also)  # few files per sub-partition; large ones are split by size
    writer = out.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*also) if also else writer).parquet(target)
    return int(seen.get["rows"])


def read_runs(spark: SparkSession, path: str, which: Sequence[str] | None = None, column: str = RUN_ID) -> DataFrame:
    """Rows of the runs ``which`` (all by default), with their label as text; files of other runs are not listed."""
    schema = schema_of(spark, path)
    if schema is None:
        raise FileNotFoundError(f"no table at {path}")
    schema = T.StructType([T.StructField(f.name, T.StringType() if f.name == column else f.dataType) for f in schema.fields])
    if which is not None and not len(which):
        return spark.createDataFrame([], schema)
    at = [path] if which is None else [folder(path, **{column: x}) for x in which]
    return spark.read.schema(schema).option("basePath", path).parquet(*at)


def read_run(spark: SparkSession, path: str, label, column: str = RUN_ID) -> DataFrame:
    """Rows of one run, without the label; a run that is not there raises."""
    if not _glob(spark, folder(path, **{column: label})):
        raise FileNotFoundError(f"no run {label} at {path}")
    return read_runs(spark, path, [label], column).drop(column)

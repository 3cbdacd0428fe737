"""Delimited files and Parquet tables.

CSV readers take an explicit schema by default; inference is opt-in because
it costs an extra pass and guesses types from text (``2026-05`` becomes a
timestamp, a bare time gets today's date).
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import urlparse

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values that must equal the reference's for the same results.
CSV_DIALECT = {"header": "true", "sep": ",", "quote": '"', "escape": "\\"}

# Spark's default CSV formats cut timestamps to milliseconds; readers accept any fraction.
CSV_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str | None = None,
    infer: bool = False,
    multi_line: bool = True,
    with_source_file: bool = False,
    mode: str = "PERMISSIVE",
) -> DataFrame:
    """Header CSV in the landing dialect.

    ``multi_line`` keeps quoted newlines inside one value, as the landing
    writer emits them; files known to have none can be read without it, and
    are then split across tasks.  Empty fields read as NULL.  ``mode`` is Spark's
    parse mode: PERMISSIVE turns a value that does not fit the schema into
    NULL, FAILFAST raises on it.
    """
    r = spark.read.options(**CSV_DIALECT).option("multiLine", str(multi_line).lower()).option("mode", mode)
    if schema is not None:
        r = r.schema(schema)
    elif infer:
        r = r.option("inferSchema", "true")
    df = r.csv(path)
    if with_source_file:
        df = df.withColumn("_source_file", F.col("_metadata.file_path"))
    return df


def apply_mapping(df: DataFrame, mapping: Sequence[tuple[str, str, str]], lenient: bool = False) -> DataFrame:
    """Explicit column list: (source name, sink name, Spark type) with conversion.

    Columns not listed are left out; a ``string`` sink type renders
    timestamps as text.  ``lenient`` converts with ``try_cast`` (a value that
    does not fit becomes NULL instead of failing the copy).
    """
    def conv(src: str, t: str):
        return F.col(src).try_cast(t) if lenient else F.col(src).cast(t)

    return df.select(*[conv(src, t).alias(dst) for src, dst, t in mapping])


#: What landed text spells differently: a line break inside a value would keep the file from being split, a
#: backslash is the dialect's escape, and the sign that introduces the spelling itself.
LANDED_SPELLING = (("%", "%25"), ("\n", "%0A"), ("\r", "%0D"), ("\\", "%5C"))
LANDED_MARK = "_spelled"  # beside the files that ``land_csv`` wrote; readers skip it
LANDED_ROWS = 1_000_000  # rows of a landed file at most


def _spelled(c: Column) -> Column:
    for plain, coded in LANDED_SPELLING:
        c = F.replace(c, F.lit(plain), F.lit(coded))
    return c


def _unspelled(c: Column) -> Column:
    for plain, coded in reversed(LANDED_SPELLING):
        c = F.replace(c, F.lit(coded), F.lit(plain))
    return c


def _each_text(df: DataFrame, rule) -> DataFrame:
    return df.withColumns({f.name: rule(F.col(f"`{f.name}`")) for f in df.schema.fields if isinstance(f.dataType, T.StringType)})


def unspelled(df: DataFrame) -> DataFrame:
    """Text columns as they were before ``land_csv`` spelled them."""
    return _each_text(df, _unspelled)


def land_csv(
    df: DataFrame,
    base: str,
    entity: str,
    load_date: str,
    mapping: Sequence[tuple[str, str, str]] | None = None,
    quote_all: bool = True,
    file_rows: int = LANDED_ROWS,
) -> str:
    """Write ``df`` to ``<base>/<entity>/<load_date>/`` as header CSV, every value quoted.

    Line breaks inside values are spelled ``%0A`` / ``%0D`` (and ``%``,
    backslash ``%25``, ``%5C``), so every record is one line and a reader can
    split a file; files hold ``file_rows`` rows at most.  ``read_landed``
    reads it back.  Returns the folder.  ``load_date`` is an argument (the
    landing date of the run), never the clock.  Re-landing the same date
    replaces that folder.
    """
    out = apply_mapping(df, mapping) if mapping else df
    path = f"{base.rstrip('/')}/{entity}/{load_date}"
    _each_text(out, _spelled).write.mode("overwrite").options(**CSV_DIALECT, **CSV_TIMES).option(
        "quoteAll", str(quote_all).lower()).option("maxRecordsPerFile", str(file_rows)).csv(path)
    spark = df.sparkSession
    spark.createDataFrame([("%",)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/{LANDED_MARK}")
    return path


def is_landed(spark: SparkSession, path: str) -> bool:
    """Whether ``land_csv`` wrote the folder (its mark is there)."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{LANDED_MARK}")
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def read_landed(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, infer: bool = False, mode: str = "PERMISSIVE",
    with_source_file: bool = False,
) -> DataFrame:
    """A landing folder: split by bytes across tasks if ``land_csv`` wrote it, else one task per (foreign) file.

    Foreign files may hold quoted line breaks, which only a reader of whole
    files can tell from record ends; their text is taken as it is.
    """
    own = is_landed(spark, path)
    df = read_csv(spark, path, schema, infer, multi_line=not own, with_source_file=with_source_file, mode=mode)
    return unspelled(df) if own else df


def read_table(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """Overwrite (schema replaced) or append a Parquet table.

    Refuses to overwrite a folder the DataFrame itself reads from: Spark
    would delete its own input first.
    """
    if mode == "overwrite":
        host, folder = _norm(path)
        for f in df.inputFiles():
            fh, fp = _norm(f)
            if fh == host and (fp + "/").startswith(folder + "/"):
                raise ValueError(f"refusing to overwrite {path}: the DataFrame reads from it")
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def _norm(p: str) -> tuple[str, str]:
    """(host, path) of a file URI or plain path: ``file:/a``, ``file:///a`` and ``/a`` agree."""
    u = urlparse(p)
    return u.netloc, u.path.rstrip("/")


def _footer_session(spark: SparkSession) -> SparkSession:
    """A session over the same context whose Parquet reads answer counts and extremes from file footers."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "csv,json,text,orc,avro")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    own.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    return own


def footer_rows(spark: SparkSession, path: str, columns: Sequence[str] = (), extremes: Sequence[str] = ()) -> DataFrame:
    """``rows`` per value of the partition ``columns``, and min_/max_ of ``extremes``: no row is read.

    The Parquet source answers from row-group footers (aggregate push-down).
    ``columns`` must be partition columns (as text); ``extremes`` numbers or
    dates that the files keep statistics of.
    """
    t = _footer_session(spark).read.parquet(path)
    aggs = [F.count(F.lit(1)).alias("rows")]
    for c in extremes:
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    return t.groupBy(*columns).agg(*aggs)


def safe_count(spark: SparkSession, path: str) -> int:
    """Row count of a table from its file footers; 0 when there is no table (missing or empty folder), other errors raise."""
    try:
        return int(footer_rows(spark, path).first()["rows"])
    except AnalysisException as e:
        cond = e.getCondition() or ""
        if "PATH_NOT_FOUND" in cond or "UNABLE_TO_INFER_SCHEMA" in cond or "Path does not exist" in str(e):
            return 0
        raise

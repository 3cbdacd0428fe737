"""JDBC sources and sinks (reports, audit table, landing from a SQL database).

Publishing goes through a side table named after the run: tasks write there,
and one transaction then replaces the report's rows (or those of the run) by
the side table's distinct rows.  A task that is run twice, or a publish that
is repeated, changes nothing.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """Read a SQL table; with a numeric ``partition_column`` it is read by
    ``num_partitions`` parallel range queries instead of one stream."""
    props = dict(properties)
    props.setdefault("fetchsize", str(fetch_size))
    if partition_column is not None:
        return spark.read.jdbc(
            url, table, column=partition_column, lowerBound=lower_bound, upperBound=upper_bound,
            numPartitions=num_partitions, properties=props,
        )
    return spark.read.jdbc(url, table, properties=props)


def publish_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str], batch_size: int = 10_000,
                 num_partitions: int | None = None) -> None:
    """Truncate and reload a report table (keeps its definition and indexes).

    ``num_partitions`` caps concurrent connections by coalescing first.
    """
    out = df.coalesce(num_partitions) if num_partitions else df
    (
        out.write.mode("overwrite")
        .option("truncate", "true")
        .option("batchsize", str(batch_size))
        .jdbc(url, table, properties=dict(properties))
    )


def append_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str]) -> None:
    df.write.mode("append").jdbc(url, table, properties=dict(properties))


def run_statements(spark: SparkSession, url: str, statements: Sequence[str], properties: Mapping[str, str]) -> None:
    """SQL statements in one transaction over one connection of the driver; any failure undoes all of them."""
    jvm = spark.sparkContext._jvm
    props = jvm.java.util.Properties()
    for k, v in properties.items():
        props.setProperty(k, str(v))
    if "driver" in properties:
        jvm.java.lang.Class.forName(properties["driver"])
    con = jvm.java.sql.DriverManager.getConnection(url, props)
    try:
        con.setAutoCommit(False)
        for s in statements:
            st = con.createStatement()
            st.execute(s)
            st.close()
        con.commit()
    except Exception:
        con.rollback()
        raise
    finally:
        con.close()


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def side_table(table: str, run_id: str) -> str:
    """The side table of a run: the report's name, the run id's letters and digits, and a digest of the run id."""
    return f"{table}__{re.sub(r'[^A-Za-z0-9]', '', run_id)[:20]}_{uuid.uuid5(uuid.NAMESPACE_OID, run_id).hex[:8]}"


def publish_run(
    df: DataFrame, url: str, table: str, run_id: str, properties: Mapping[str, str], run_column: str | None = None,
    batch_size: int = 10_000, num_partitions: int | None = None, execute: Callable[[Sequence[str]], None] | None = None,
) -> int:
    """Replace the rows of ``table`` (with ``run_column``: its rows of this run) by ``df``; returns the rows published.

    The rows are written once to the shared folder with a row id, then to the
    run's side table.  One transaction deletes the old rows and inserts the
    distinct (row id, row) pairs, so rows that a retried task wrote twice
    count once.  The side table is dropped last; a publish that failed
    anywhere can be repeated.  ``execute`` runs statements as one transaction.
    """
    from strata.operators.dedupe import ROW_ID, stage

    spark = df.sparkSession
    execute = execute or (lambda statements: run_statements(spark, url, statements, properties))
    rows, side = stage(df, name="publish"), side_table(table, run_id)
    props = dict(properties)
    df.limit(0).write.mode("append").jdbc(url, table, properties=props)  # makes a table that is not there
    out = rows.coalesce(num_partitions) if num_partitions else rows
    out.write.mode("overwrite").option("batchsize", str(batch_size)).jdbc(url, side, properties=props)
    names = ", ".join(df.columns)
    which = f" WHERE {run_column} = {_text(run_id)}" if run_column else ""
    execute([f"DELETE FROM {table}{which}",
             f"INSERT INTO {table} ({names}) SELECT {names} FROM (SELECT DISTINCT {ROW_ID}, {names} FROM {side}) r"])
    execute([f"DROP TABLE {side}"])
    return rows.count()


def publish_all(
    spark: SparkSession, url: str, tables: Sequence[tuple[str, str | Callable[[], DataFrame]]], properties: Mapping[str, str],
    run_id: str = "latest", execute: Callable[[Sequence[str]], None] | None = None,
) -> dict[str, int]:
    """Publish each (sql table, Parquet path or function that gives its rows); returns rows written per table."""
    written = {}
    for tbl, path in tables:
        rows = path() if callable(path) else spark.read.parquet(path)
        written[tbl] = publish_run(rows, url, tbl, run_id, properties, execute=execute)
    return written


def balanced_predicates(
    spark: SparkSession, url: str, table: str, column: str, parts: int, properties: Mapping[str, str], sample: str = "{table}",
) -> list[str]:
    """Disjoint SQL conditions on ``column`` that cover every row of ``table`` once, with about equal numbers of rows.

    The database cuts a sample of the column into ``parts`` equal tiles and
    returns the greatest value of each (``parts`` rows); ``sample`` names what
    it samples, e.g. ``"{table} TABLESAMPLE (1 PERCENT)"``.  Ranges end at
    those values, so a skewed key gets narrow ranges where it is dense; a value
    that fills several tiles has one range.  NULLs have a condition of their
    own.  Values outside the sample fall into the open first and last range.
    """
    tiles = (f"(SELECT MAX(v) AS top FROM (SELECT {column} AS v, NTILE({int(parts)}) OVER (ORDER BY {column}) AS tile "
             f"FROM {sample.format(table=table)} WHERE {column} IS NOT NULL) t GROUP BY tile) tops")
    found = sorted({r["top"] for r in spark.read.jdbc(url, tiles, properties=dict(properties)).collect() if r["top"] is not None})
    cut = [str(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else _text(str(v)) for v in found[:-1]]
    if not cut:
        return [f"{column} IS NULL", f"{column} IS NOT NULL"]
    ranges = [f"{column} <= {cut[0]}"] + [f"{column} > {a} AND {column} <= {b}" for a, b in zip(cut, cut[1:])] + [f"{column} > {cut[-1]}"]
    return [f"{column} IS NULL", *ranges]


def read_jdbc_balanced(
    spark: SparkSession, url: str, table: str, column: str, parts: int, properties: Mapping[str, str], sample: str = "{table}",
    fetch_size: int = 10_000,
) -> DataFrame:
    """Read a SQL table by ranges of ``column`` that hold about equally many rows, one task each."""
    props = dict(properties)
    props.setdefault("fetchsize", str(fetch_size))
    where = balanced_predicates(spark, url, table, column, parts, properties, sample)
    return spark.read.jdbc(url, table, predicates=where, properties=props)


def land_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    mapping: Sequence[tuple[str, str, str]],
    base: str,
    entity: str,
    load_date: str,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    sample: str = "{table}",
) -> str:
    """Copy a SQL table to ``<base>/<entity>/<load_date>/`` as quoted CSV through a column mapping.

    With a ``partition_column`` the read is split into ``num_partitions``
    queries: even ranges between the bounds where they are given, else ranges
    that hold about equally many rows (:func:`balanced_predicates`).  Returns
    the landing folder.
    """
    from strata.sources.files import land_csv

    if partition_column is not None and lower_bound is None and num_partitions:
        src = read_jdbc_balanced(spark, url, table, partition_column, num_partitions, properties, sample)
    else:
        src = read_jdbc(spark, url, table, properties, partition_column, lower_bound, upper_bound, num_partitions)
    return land_csv(src, base, entity, load_date, mapping)

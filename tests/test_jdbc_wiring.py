"""JDBC functions: what they hand to Spark's reader and writer (no database is started).

Spark's own ``jdbc`` calls are replaced by recorders, so these tests check the
options each function sets (modes, truncate, batching, parallel reads), not
a database round trip.
"""

import pytest
from pyspark.sql.readwriter import DataFrameReader, DataFrameWriter

from strata.sources import jdbc


@pytest.fixture
def recorded(monkeypatch):
    calls = {"writer": [], "reader": []}
    orig_mode, orig_option = DataFrameWriter.mode, DataFrameWriter.option

    def mode(self, m):
        calls["writer"].append(("mode", m))
        return orig_mode(self, m)

    def option(self, k, v):
        calls["writer"].append(("option", k, v))
        return orig_option(self, k, v)

    monkeypatch.setattr(DataFrameWriter, "mode", mode)
    monkeypatch.setattr(DataFrameWriter, "option", option)
    monkeypatch.setattr(DataFrameWriter, "jdbc",
                        lambda self, url, table, mode=None, properties=None: calls["writer"].append(
                            ("jdbc", url, table, dict(properties or {}))))
    monkeypatch.setattr(DataFrameReader, "jdbc",
                        lambda self, url, table, column=None, lowerBound=None, upperBound=None, numPartitions=None,
                        predicates=None, properties=None: calls["reader"].append(
                            (url, table, column, lowerBound, upperBound, numPartitions, dict(properties or {}))))
    return calls


def test_publish_truncates_and_batches(spark, recorded):
    df = spark.range(3)
    jdbc.publish_jdbc(df, "jdbc:x", "dbo.rpt_t", {"user": "u"}, batch_size=500, num_partitions=2)
    w = recorded["writer"]
    assert ("mode", "overwrite") in w
    assert ("option", "truncate", "true") in w and ("option", "batchsize", "500") in w
    assert ("jdbc", "jdbc:x", "dbo.rpt_t", {"user": "u"}) in w


def test_append_uses_append_mode(spark, recorded):
    jdbc.append_jdbc(spark.range(1), "jdbc:x", "dbo.pipeline_audit", {})
    assert ("mode", "append") in recorded["writer"]
    assert recorded["writer"][-1][:3] == ("jdbc", "jdbc:x", "dbo.pipeline_audit")


def test_read_is_parallel_when_a_partition_column_is_given(spark, recorded):
    jdbc.read_jdbc(spark, "jdbc:x", "dbo.src", {"user": "u"})
    jdbc.read_jdbc(spark, "jdbc:x", "dbo.src", {}, partition_column="id", lower_bound=1, upper_bound=1000,
                   num_partitions=8)
    single, parallel = recorded["reader"]
    assert single[2] is None and single[6]["fetchsize"] == "10000"
    assert parallel[2:6] == ("id", 1, 1000, 8)


def test_land_table_maps_and_quotes(spark, monkeypatch):
    import datetime as dt

    from strata.session import shared_dir
    from strata.sources.files import read_csv

    src = spark.createDataFrame([("D1", "One", dt.datetime(2026, 5, 1, 8, 30))],
                                "department_id STRING, department_name STRING, last_updated TIMESTAMP_NTZ")
    monkeypatch.setattr(DataFrameReader, "jdbc", lambda self, url, table, **kw: src)
    mapping = [("department_id", "department_id", "string"), ("department_name", "department_name", "string"),
               ("last_updated", "last_updated", "string")]
    folder = jdbc.land_table(spark, "jdbc:x", "dbo.src_department_master", {}, mapping, shared_dir(spark, "raw"),
                             "department", "2026-05-21")
    assert folder.endswith("department/2026-05-21")
    assert all(line.value.startswith('"') for line in spark.read.text(folder).collect())
    row = read_csv(spark, folder, schema="department_id STRING, department_name STRING, last_updated STRING").first()
    assert (row.department_id, row.last_updated) == ("D1", "2026-05-01 08:30:00")


def test_publish_run_goes_through_a_side_table_and_one_transaction(spark, recorded):
    done = []
    df = spark.createDataFrame([("D1", 3), ("D1", 3), ("D2", 4)], "department_id STRING, headcount INT")
    for _ in range(2):  # a repeated publish does the same again
        assert jdbc.publish_run(df, "jdbc:x", "dbo.rpt_t", "run 1's", {"user": "u"}, execute=done.append) == 3
    side = jdbc.side_table("dbo.rpt_t", "run 1's")
    writes = [w for w in recorded["writer"] if w[0] == "jdbc" or w[1] in ("append", "overwrite")]
    once = [("mode", "append"), ("jdbc", "jdbc:x", "dbo.rpt_t", {"user": "u"}), ("mode", "overwrite"), ("jdbc", "jdbc:x", side, {"user": "u"})]
    assert [w for w in writes if w in once] == once * 2
    insert = ("INSERT INTO dbo.rpt_t (department_id, headcount) SELECT department_id, headcount FROM "
              f"(SELECT DISTINCT _row_id, department_id, headcount FROM {side}) r")
    assert done == [["DELETE FROM dbo.rpt_t", insert], [f"DROP TABLE {side}"]] * 2
    assert side != jdbc.side_table("dbo.rpt_t", "run 1s") and side.replace("_", "").replace(".", "").isalnum()


def test_rows_that_a_retried_task_wrote_twice_count_once(spark, monkeypatch):
    held = {}
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, url, table, mode=None, properties=None: held.__setitem__(
        table, self._df.unionByName(self._df.limit(2))))  # two rows arrive twice
    done = []
    df = spark.createDataFrame([("D1", 3), ("D1", 3), ("D2", 4)], "department_id STRING, headcount INT").coalesce(1)
    jdbc.publish_run(df, "jdbc:x", "rpt_t", "r1", {}, run_column="run_id", execute=done.append)
    side = jdbc.side_table("rpt_t", "r1")
    held[side].createOrReplaceTempView(side)
    assert done[0][0] == "DELETE FROM rpt_t WHERE run_id = 'r1'"
    rows = spark.sql(done[0][1].split(") ", 1)[1]).collect()
    assert sorted(map(tuple, rows)) == [("D1", 3), ("D1", 3), ("D2", 4)]


@pytest.mark.parametrize("kind", ["skewed", "text", "one", "empty"])
def test_balanced_ranges_cover_every_row_once(spark, monkeypatch, kind):
    keys = {"skewed": [1] * 300 + list(range(1, 101)) + [10**6 * i for i in range(1, 101)] + [None] * 7,
            "text": [f"k'{i % 37:02d}" for i in range(400)] + [None], "one": [5] * 50, "empty": []}[kind]
    src = spark.createDataFrame([(k,) for k in keys], "id STRING" if kind == "text" else "id BIGINT")
    src.createOrReplaceTempView("src_t")
    seen = []

    def reader(self, url, table, predicates=None, properties=None, **kw):
        seen.append((table, predicates, properties))
        return src if predicates else spark.sql(f"SELECT * FROM {table}")

    monkeypatch.setattr(DataFrameReader, "jdbc", reader)
    jdbc.read_jdbc_balanced(spark, "jdbc:x", "src_t", "id", 8, {"user": "u"})
    (tiles, _, _), (table, where, props) = seen
    assert "NTILE(8)" in tiles and table == "src_t" and props["fetchsize"] == "10000"
    hits = [src.filter(w).count() for w in where]
    once = " + ".join(f"CAST(coalesce({w}, false) AS INT)" for w in where)
    assert sum(hits) == len(keys) and src.filter(f"{once} <> 1").count() == 0
    assert hits[0] == sum(k is None for k in keys)
    if kind == "skewed":  # the value 1 holds most rows and has a range of its own; the rest is dealt evenly
        assert len(where) > 3 and max(h for h in hits if h < 300) <= 2 * 500 // 8


def test_landing_without_bounds_is_balanced(spark, monkeypatch):
    from strata.session import shared_dir

    src, seen = spark.range(100).selectExpr("id", "cast(id as string) AS name"), []
    src.createOrReplaceTempView("src_land")

    def reader(self, url, table, predicates=None, properties=None, **kw):
        seen.append(predicates)
        return src if predicates else spark.sql(f"SELECT * FROM {table}")

    monkeypatch.setattr(DataFrameReader, "jdbc", reader)
    jdbc.land_table(spark, "jdbc:x", "src_land", {}, [("id", "id", "bigint")], shared_dir(spark, "raw"), "t", "2026-05-21",
                    partition_column="id", num_partitions=4)
    assert seen[0] is None and len(seen[1]) == 5

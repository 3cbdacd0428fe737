"""Files, bronze appends, partitioned tables, streaming ingest and the end-to-end run."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strata.operators import scd2_store, snapshots
from strata.operators.bronze import ingest_bronze, latest_from_bronze, read_bronze, runs_summary
from strata.session import shared_dir
from strata.sources.files import apply_mapping, land_csv, read_csv, read_landed, safe_count, write_table


def test_csv_landing_roundtrip_quotes_and_nulls(spark):
    df = spark.createDataFrame(
        [(1, 'a "quoted", text', None, dt.datetime(2026, 5, 20, 9, 0, 0)), (2, "", "x", None)],
        "id INT, txt STRING, other STRING, ts TIMESTAMP_NTZ")
    base = shared_dir(spark, "raw")
    folder = land_csv(df, base, "things", "2026-05-21",
                      mapping=[("id", "id", "int"), ("txt", "txt", "string"), ("other", "other", "string"),
                               ("ts", "ts_text", "string")])
    assert folder.endswith("things/2026-05-21")
    text = spark.read.text(folder).collect()
    assert all(line.value.startswith('"') for line in text)  # every value quoted
    back = read_csv(spark, folder, schema="id INT, txt STRING, other STRING, ts_text STRING",
                    with_source_file=True).orderBy("id").collect()
    assert back[0].txt == 'a "quoted", text' and back[0].other is None
    assert back[0].ts_text == "2026-05-20 09:00:00"
    assert back[1].txt is None  # empty text reads as NULL
    assert back[0]._source_file.endswith(".csv")


def test_csv_multiline_option(spark, tmp_path):
    p = tmp_path / "m.csv"
    p.write_text('id,txt\n1,"line one\nline two"\n2,plain\n')
    split = read_csv(spark, str(p), schema="id INT, txt STRING", multi_line=False).count()
    whole = read_csv(spark, str(p), schema="id INT, txt STRING").collect()
    assert split == 3  # Q19: a quoted newline splits the row without multiLine
    assert len(whole) == 2 and whole[0].txt == "line one\nline two"


def test_apply_mapping_drops_and_casts(spark):
    df = spark.createDataFrame([(1, 2.5, "z")], "a INT, b DOUBLE, c STRING")
    out = apply_mapping(df, [("a", "x", "string"), ("b", "y", "decimal(18,2)")])
    assert out.columns == ["x", "y"] and out.first().y == Decimal("2.50")


def test_bronze_rerun_replaces_its_run_and_schema_evolves(spark):
    path = shared_dir(spark, "bronze")
    base = spark.createDataFrame([(1, "a"), (2, "b")], "id INT, v STRING")
    ingest_bronze(base, "r1", "2026-05-20 00:00:00", path, source_file=False)
    ingest_bronze(base, "r2", "2026-05-21 00:00:00", path, source_file=False)
    ingest_bronze(base, "r2", "2026-05-21 00:00:00", path, source_file=False)  # re-run
    wider = base.withColumn("extra", F.lit("e"))
    ingest_bronze(wider, "r3", "2026-05-22 00:00:00", path, source_file=False)
    b = read_bronze(spark, path)
    assert {(r._run_id, r.rows) for r in runs_summary(b).collect()} == {("r1", 2), ("r2", 2), ("r3", 2)}
    assert b.filter("_run_id = 'r1'").select("extra").distinct().first().extra is None
    assert b.filter("_run_id = 'r3'").select("extra").distinct().first().extra == "e"


def test_safe_count_and_overwrite_guard(spark):
    assert safe_count(spark, shared_dir(spark, "missing")) == 0
    path = shared_dir(spark, "t")
    spark.range(5).write.parquet(path)
    assert safe_count(spark, path) == 5
    with pytest.raises(ValueError):
        write_table(spark.read.parquet(path), path)


def _land_fixture_run(spark, base, run_date, employees):
    att = spark.createDataFrame(
        [(1, "E1", "2026-05-20", "Present", "2026-05-20 09:00:00", "2026-05-20 17:30:00"),
         (2, "E1", "2026-05-20", "Present", "2026-05-20 09:05:00", "2026-05-20 17:30:00"),
         (3, "E2", "2026-05-20", "Absent", "2026-05-20 09:00:00", None)],
        "a STRING, b STRING, c STRING, d STRING, e STRING, f STRING").toDF(
        "attendance_id", "employee_id", "attendance_date", "attendance_status", "check_in_time", "check_out_time")
    pay = spark.createDataFrame(
        [("1", "E1", "2026-05-01", "1000.00", "100.00", "50.00", "1050.00", "2026-05-31"),
         ("2", "E1", "2026-05-01", "1000.00", "100.00", "50.00", "1050.01", "2026-06-02"),
         ("3", "E2", "2026-05-01", "1000.00", "0.00", "50.00", "950.02", "2026-05-30")],
        "payroll_id STRING, employee_id STRING, pay_period STRING, basic_salary STRING, bonus_amount STRING, "
        "deduction_amount STRING, net_pay STRING, processed_date STRING")
    emp = spark.createDataFrame(employees, "employee_id STRING, department_id STRING, designation STRING, "
                                "manager_id STRING, salary STRING, employment_status STRING, hire_date STRING")
    dept = spark.createDataFrame([("D1", "One", "BU", "L", "Y", "2026-05-01 00:00:00")],
                                 "department_id STRING, department_name STRING, business_unit STRING, "
                                 "location STRING, active_status STRING, last_updated STRING")
    raw = f"{base}/raw"
    for name, df in (("attendance", att), ("payroll", pay), ("employee", emp), ("department", dept)):
        land_csv(df, raw, name, run_date)


def test_end_to_end_run(spark):
    from strata.plans.orchestrate import RunParams, run_all

    base = shared_dir(spark, "lake")
    clock = lambda: dt.datetime(2026, 5, 21, 6, 0, 0)
    _land_fixture_run(spark, base, "2026-05-20", [
        ("E1", "D1", "Eng", "M", "100.00", "Active", "2020-01-01"),
        ("E2", "D1", "Eng", "M", "200.00", "Resigned", "2021-01-01")])
    p1 = RunParams(base, "r1", "2026-05-20", "2026-05-20 23:00:00", n_months=3, buckets=2, clock=clock)
    res, audit = run_all(spark, p1)
    assert all(o.status == "SUCCESS" for o in res), res
    a = audit.first()
    # silver: 2 attendance + 2 payroll + 2 employee rows; rejected: 1 + 1
    assert (a.records_read, a.records_rejected, a.status) == (6, 2, "Success")
    _land_fixture_run(spark, base, "2026-05-21", [
        ("E1", "D1", "Eng", "M", "150.00", "Active", "2020-01-01"),
        ("E2", "D1", "Eng", "M", "200.00", "Resigned", "2021-01-01"),
        ("E3", "D1", "Ops", "M", "300.00", "Active", "2026-05-01")])
    p2 = RunParams(base, "r2", "2026-05-21", "2026-05-21 23:00:00", n_months=3, buckets=2, clock=clock, cluster=True)
    res, audit = run_all(spark, p2)
    emp = scd2_store.read(spark, p2.path("silver", "employee"))
    assert emp.count() == 4 and emp.filter("is_current").count() == 3
    ws = snapshots.read_partition(spark, p2.path("gold", "workforce_summary")).first()
    assert (ws.headcount, ws.active_count, ws.attrition_count, ws.department_name) == (3, 2, 1, "One")
    ap = {r.employee_id: r for r in snapshots.read_partition(spark, p2.path("gold", "attendance_payroll")).collect()}
    assert (ap["E1"].days_present, ap["E2"].days_absent) == (1, 1)
    hc = snapshots.read_partition(spark, p2.path("gold", "dept_headcount_history")).collect()
    assert [(r.snapshot_month, r.headcount) for r in hc] == [("2026-05", 2)]  # E1 (new version) and E3
    rej = spark.read.parquet(p2.path("rejected", "attendance"))
    assert {r._run_id: r.n for r in rej.groupBy("_run_id").agg(F.count("*").alias("n")).collect()} == {"r1": 1, "r2": 1}
    assert audit.first().records_read == 2 + 2 + 4


def test_run_records_failed_steps_and_continues(spark):
    from strata.plans.orchestrate import RunParams, run_all

    base = shared_dir(spark, "lake_fail")
    _land_fixture_run(spark, base, "2026-05-20", [("E1", "D1", "Eng", "M", "100.00", "Active", "2020-01-01")])
    # payroll lands nowhere for this date: its steps fail, the others still run
    p = RunParams(base, "r1", "2026-05-20", "2026-05-20 23:00:00", n_months=3, buckets=2,
                  clock=lambda: dt.datetime(2026, 5, 21, 6, 0, 0))
    jvm = spark.sparkContext._jvm
    raw_pay = jvm.org.apache.hadoop.fs.Path(p.path("raw", "payroll"))
    raw_pay.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(raw_pay, True)
    with pytest.raises(RuntimeError):
        run_all(spark, p)
    res, audit = run_all(spark, RunParams(**{**p.__dict__, "run_id": "r1b"}), raise_on_failure=False)
    status = {o.table: o.status for o in res}
    assert status["bronze_payroll"] == "FAILED" and status["silver_payroll"] == "SKIPPED"
    assert status["gold_workforce_summary"] == "SUCCESS"
    a = audit.first()
    assert a.status == "PartialFailure" and "bronze_payroll" in a.error_message


def test_bad_values_fail_in_parity_and_are_rejected_in_strict(spark):
    from strata.plans.orchestrate import RunParams, _bronze

    base = shared_dir(spark, "lake_bad")
    pay = spark.createDataFrame(
        [("1", "E1", "2026-05-01", "1000.00", "1.00", "0.00", "1001.00", "2026-05-31"),
         ("2", "E2", "2026-05-01", "abc", "1.00", "0.00", "1.00", "2026-05-31")],
        "payroll_id STRING, employee_id STRING, pay_period STRING, basic_salary STRING, bonus_amount STRING, "
        "deduction_amount STRING, net_pay STRING, processed_date STRING")
    land_csv(pay, f"{base}/raw", "payroll", "2026-05-20")
    p = RunParams(base, "r1", "2026-05-20", "2026-05-20 23:00:00")
    with pytest.raises(Exception):
        _bronze(spark, p, "payroll")
    ps = RunParams(base, "r2", "2026-05-20", "2026-05-20 23:00:00", strict=True)
    assert _bronze(spark, ps, "payroll") == 1
    rej = spark.read.parquet(ps.path("rejected", "payroll_values")).collect()
    assert [(r.payroll_id, r.bad_columns, r._run_id) for r in rej] == [("2", "basic_salary", "r2")]


def test_safe_count_empty_folder(spark, tmp_path):
    d = tmp_path / "empty"
    d.mkdir()
    assert safe_count(spark, str(d)) == 0


def test_audit_record_literal_row(spark):
    from strata.operators.audit import AUDIT_SCHEMA, audit_record

    row = audit_record(spark, ["r1", "pl_master_hr", "all_sources", "Full", dt.datetime(2026, 5, 21, 6),
                               dt.datetime(2026, 5, 21, 7), 10, 10, 0, 2, "Success", None])
    assert row.schema == AUDIT_SCHEMA and row.first().records_rejected == 2


def test_timestamps_keep_microseconds_and_newlines(spark):
    rows = [(1, dt.datetime(2026, 5, 20, 9, 0, 0, 123456), dt.datetime(2026, 5, 20, 9, 0, 0, 1), "a\nb"),
            (2, dt.datetime(2026, 5, 20, 9, 0, 0), None, "c")]
    df = spark.createDataFrame(rows, "id INT, n TIMESTAMP_NTZ, t TIMESTAMP, txt STRING")
    folder = land_csv(df, shared_dir(spark, "raw"), "times", "2026-05-21")
    back = read_landed(spark, folder, schema="id INT, n TIMESTAMP_NTZ, t TIMESTAMP, txt STRING")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_run_id_stays_text(spark):
    path = shared_dir(spark, "bronze_ids")
    ingest_bronze(spark.createDataFrame([(1,)], "id INT"), "001", "2026-05-20 00:00:00", path, source_file=False)
    assert read_bronze(spark, path).first()._run_id == "001"
    assert read_bronze(spark, path, read_bronze(spark, path).schema).first()._run_id == "001"


def test_latest_over_skipped_repeated_and_late_runs(spark):
    path = shared_dir(spark, "bronze_latest")

    def put(run, ts, rows):
        ingest_bronze(spark.createDataFrame(rows, "id INT, v STRING"), run, ts, path, source_file=False)

    def latest():
        return {r.id: r.v for r in latest_from_bronze(read_bronze(spark, path), "id").collect()}

    put("r1", "2026-05-01 00:00:00", [(1, "a"), (2, "a")])
    put("r2", "2026-05-02 00:00:00", [(2, "b"), (3, "b")])  # appended, never looked at
    put("r3", "2026-05-03 00:00:00", [(4, "c")])
    assert latest() == {1: "a", 2: "b", 3: "b", 4: "c"}
    put("r1", "2026-05-01 00:00:00", [(1, "z")])  # corrected: id 2 is no longer in r1
    assert latest() == {1: "z", 2: "b", 3: "b", 4: "c"}
    put("r0", "2026-04-30 00:00:00", [(1, "old"), (5, "old")])  # late
    assert latest() == {1: "z", 2: "b", 3: "b", 4: "c", 5: "old"}


def test_streaming_ingest_reads_each_file_once(spark):
    from strata.streaming.ingest import ingest_available

    raw, bronze, ckpt = shared_dir(spark, "sraw"), shared_dir(spark, "sbronze"), shared_dir(spark, "sckpt")
    day1 = spark.range(0, 300).select(F.col("id").cast("int").alias("id"), F.lit("x").alias("v")).repartition(3)
    land_csv(day1, raw, "ev", "2026-05-20")
    ingest_available(spark, raw, "id INT, v STRING", bronze, ckpt, "r1", "2026-05-20 00:00:00", max_files_per_trigger=1)
    ingest_available(spark, raw, "id INT, v STRING", bronze, ckpt, "r1b", "2026-05-20 00:00:00")  # nothing new
    land_csv(day1.limit(100), raw, "ev", "2026-05-21")
    ingest_available(spark, raw, "id INT, v STRING", bronze, ckpt, "r2", "2026-05-21 00:00:00")
    b = read_bronze(spark, bronze)
    assert {r._run_id: r.rows for r in runs_summary(b).collect()} == {"r1": 300, "r2": 100}
    assert b.filter("_run_id = 'r1'").select("_batch").distinct().count() == 3
    assert b.filter("_source_file LIKE '%2026-05-21%'").count() == 100


def test_replayed_stream_batch_replaces_its_output(spark):
    from strata.streaming.ingest import _writer

    bronze = shared_dir(spark, "replay")
    batch = spark.range(10).select("id", F.lit("r1").alias("_run_id"))
    write = _writer(bronze)
    write(batch, 0)
    write(batch.withColumn("_run_id", F.lit("r2")), 0)  # the same epoch after a restart with a new run id
    write(batch.limit(1), 1)
    b = read_bronze(spark, bronze)
    assert b.filter("_batch = 0").count() == 10 and b.count() == 11
    write(batch.limit(0), 0)  # replayed without rows
    assert read_bronze(spark, bronze).count() == 1


def test_partitioned_table_by_label(spark):
    path = shared_dir(spark, "labels")
    t0 = spark.createDataFrame([(1, "Active", True), (2, "Active", True)], "k INT, s STRING, is_current BOOLEAN")
    assert snapshots.latest_label(spark, path) is None
    snapshots.write_partition(t0, path, 0, "version")
    snapshots.write_partition(t0.union(spark.createDataFrame([(3, "Resigned", True)], t0.schema)), path, 1, "version")
    assert snapshots.latest_label(spark, path, column="version") == "1"
    assert snapshots.read_partition(spark, path, column="version").count() == 3
    got = snapshots.compare_partitions(spark, path, "s = 'Resigned'", "1", "0")
    assert {r.snapshot: r.active_count for r in got.collect()} == {"now": 1, "v0": 0}  # zero counts still appear
    snapshots.write_partition(t0, path, 1, "version")  # a re-run replaces its own label only
    assert snapshots.read_partition(spark, path, "1", "version").count() == 2
    with pytest.raises(FileNotFoundError):
        snapshots.read_partition(spark, shared_dir(spark, "none"))


def test_clustered_rewrite_preserves_rows_and_splits_hot_values(spark):
    hot = spark.range(0, 8000).select(F.lit(1).alias("a"), F.col("id").alias("v"))
    path = shared_dir(spark, "hot")
    snapshots.clustered(hot, ["a"], 2000 * 16, 16).write.parquet(path)
    back = spark.read.parquet(path)
    assert back.exceptAll(hot).count() == 0 and back.count() == 8000
    assert back.groupBy(F.input_file_name()).count().count() == 4


def test_audit_counts_beyond_int(spark):
    from strata.operators.audit import audit_row, narrow_counts

    counts = spark.createDataFrame([(3_000_000_000, 2)], "records_read BIGINT, records_rejected BIGINT")
    row = audit_row(counts, "r1", "2026-01-01 00:00:00", "2026-01-01 01:00:00")
    assert row.first().records_read == 3_000_000_000
    with pytest.raises(Exception, match="too large"):
        narrow_counts(row).collect()
    failed = audit_row(counts, "r1", "2026-01-01 00:00:00", "2026-01-01 01:00:00", ["a", "b"]).first()
    assert failed.error_message == "Failed notebooks: a, b"


def test_run_order_follows_dependencies():
    from strata.plans.orchestrate import run_order, tasks

    todo = tasks()
    order = run_order(todo)
    assert sorted(order) == sorted(todo) and order[-1].startswith("publish_")
    assert all(order.index(r) < order.index(k) for k, t in todo.items() for r in t.reads)


def test_cluster_conf_sizes_partitions():
    from strata.session import cluster_conf

    big = cluster_conf(400 * 1024**4, executors=1000, cores_per_executor=8)
    assert big["spark.sql.shuffle.partitions"] == str(400 * 1024)  # grows with the input
    assert big["spark.sql.autoBroadcastJoinThreshold"] == "-1"
    small = cluster_conf(10 * 1024**3, executors=10, cores_per_executor=4)
    assert small["spark.sql.shuffle.partitions"] == "80"  # at least twice the slots

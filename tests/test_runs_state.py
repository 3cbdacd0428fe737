"""Run folders, the stored type-2 table, the latest state, footer counts, landed text and failed steps."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from strata.operators import latest_state, runs, scd2, scd2_store, snapshots
from strata.operators.bronze import append_run, ingest_bronze, latest_from_bronze, read_bronze, stored_runs
from strata.session import shared_dir
from strata.sources.files import footer_rows, land_csv, read_csv, read_landed

EMP = "employee_id INT, department_id INT, designation STRING, manager_id INT, salary INT, employment_status STRING"
TIMES = [f"2026-0{m}-01 00:00:00" for m in range(1, 8)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df, *cols):
    return sorted(map(str, (tuple(r) for r in (df.select(*cols) if cols else df).collect())))


# --- run folders

def test_a_run_is_replaced_also_by_nothing(spark):
    path = shared_dir(spark, "runs")
    one = spark.createDataFrame([(1, "a"), (2, "b")], "id INT, v STRING")
    assert [append_run(one, path, r) for r in ("001", "a:b/c=d %x", "é #1")] == [2, 2, 2]
    assert runs.labels(spark, path) == ["001", "a:b/c=d %x", "é #1"]
    assert rows_of(read_bronze(spark, path).filter("_run_id = 'a:b/c=d %x'"), "id") == ["(1,)", "(2,)"]
    before = runs.signature(spark, path, "001")
    assert append_run(one.limit(0), path, "001") == 0 and runs.signature(spark, path, "001") != before
    assert read_bronze(spark, path).filter("_run_id = '001'").count() == 0 and read_bronze(spark, path).count() == 4
    assert {r._run_id: r.rows for r in stored_runs(spark, path).collect()} == {"001": 0, "a:b/c=d %x": 2, "é #1": 2}
    assert append_run(spark.createDataFrame([], "id INT, v STRING"), path, "none yet") == 0  # an empty relation is counted too
    with pytest.raises(ValueError):
        append_run(read_bronze(spark, path), path, "é #1")  # would delete what it reads


def test_sub_partitions_of_the_first_attempt_go(spark):
    path = shared_dir(spark, "subs")
    df = spark.createDataFrame([(1, "x"), (2, "y")], "id INT, part STRING")
    snapshots.write_partition(df, path, "t1", also=("part",))
    snapshots.write_partition(df.filter("part = 'y'"), path, "t1", also=("part",))
    assert rows_of(snapshots.read_partition(spark, path, "t1")) == ["(2, 'y')"]


def test_labels_and_schema_need_no_files_of_other_runs(spark):
    path = shared_dir(spark, "many")
    for i in range(5):
        t = spark.range(4).withColumn("v", F.lit(i)) if i < 3 else spark.range(4).select("id", F.lit(i).cast("bigint").alias("v"), F.lit("n").alias("w"))
        snapshots.write_partition(t, path, f"{i:03d}", "version")
    assert snapshots.latest_label(spark, path, column="version") == "004"
    assert snapshots.latest_label(spark, path, before="003", column="version") == "002"
    old = snapshots.read_partition(spark, path, "001", "version")
    assert old.columns == ["id", "v", "w"] and dict(old.dtypes)["v"] == "bigint" and old.filter("w IS NULL AND v = 1").count() == 4
    assert all("version=001" in f for f in old.inputFiles())
    both = snapshots.compare_partitions(spark, path, "v = 4", "004", "001")
    assert {r.snapshot: r.active_count for r in both.collect()} == {"now": 4, "v0": 0}
    for missing in ("009", "x"):
        with pytest.raises(FileNotFoundError):
            snapshots.read_partition(spark, path, missing, "version")
        with pytest.raises(FileNotFoundError):
            snapshots.compare_partitions(spark, path, "true", "001", missing)
    with pytest.raises(ValueError):
        snapshots.write_partition(spark.range(1).withColumn("v", F.lit("text")), path, "005", "version")


def test_footers_answer_counts_without_reading_rows(spark):
    path = shared_dir(spark, "footers")
    spark.range(1000).withColumn("part", F.when(F.col("id") < 900, "007").otherwise("b")).write.partitionBy("part").parquet(path)
    got = footer_rows(spark, path, ("part",), ("id",))
    assert "PushedAggregation: [COUNT(*), MIN(id), MAX(id)]" in plan_of(got) and "PushedGroupBy: [part]" in plan_of(got)
    assert rows_of(got) == ["('007', 900, 0, 899)", "('b', 100, 900, 999)"]
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown", "false") == "false"  # the caller's session is as it was


# --- type-2 store

def snap(spark, rows):
    return spark.createDataFrame([(k, 1, "x", m, s, "Active") for k, m, s in rows], EMP)


def in_memory(spark, snaps, **kw):
    """The same runs by scd2_init and scd2_apply on whole tables."""
    t = scd2.scd2_init(snap(spark, snaps[0]), TIMES[0])
    for at, rows in zip(TIMES[1:], snaps[1:]):
        t = scd2.scd2_apply(t, snap(spark, rows), "employee_id", at, **kw)
        t = spark.createDataFrame(t.collect(), t.schema)
    return t


def test_corrected_rerun_equals_a_first_run(spark):
    path, fresh = shared_dir(spark, "scd2"), shared_dir(spark, "scd2")
    a, wrong, right = [(1, 7, 10), (2, None, 20), (None, 7, 5)], [(1, 7, 11), (2, 7, 21), (3, 1, 1)], [(1, 7, 10), (2, 7, 20)]
    for at, rows in ((TIMES[0], a), (TIMES[1], wrong), (TIMES[1], []), (TIMES[1], right)):
        scd2_store.apply_run(snap(spark, rows), path, at, "employee_id", buckets=4)
    for at, rows in ((TIMES[0], a), (TIMES[1], right)):
        scd2_store.apply_run(snap(spark, rows), fresh, at, "employee_id", buckets=4)
    assert rows_of(scd2_store.read(spark, path)) == rows_of(scd2_store.read(spark, fresh))
    assert scd2_store.read(spark, path).count() == 3  # two employees, and the row without a key
    with pytest.raises(ValueError):
        scd2_store.apply_run(snap(spark, a), path, TIMES[0], "employee_id")  # the second run was made from it
    with pytest.raises(FileNotFoundError):
        scd2_store.read(spark, shared_dir(spark, "none"))


@pytest.mark.parametrize("options", [{}, {"null_safe": True, "close_missing": True, "null_keys": "reject"}])
def test_store_equals_whole_table_runs(spark, options):
    r, path, snaps = random.Random(3), shared_dir(spark, "scd2"), []
    state = {k: (r.choice([None, 1, 2]), r.randrange(3)) for k in range(40)}
    for _ in range(3):
        for k in r.sample(sorted(state), 6):
            state[k] = (r.choice([None, 1, 2]), r.randrange(3))
        state[r.randrange(100, 200)] = (1, 1)
        gone = set(r.sample(sorted(state), 4))
        keys = [] if options.get("null_keys") == "reject" else [(None, 1, 1)]
        snaps.append([(k, *v) for k, v in state.items() if k not in gone] + keys)
    for at, rows in zip(TIMES, snaps):
        scd2_store.apply_run(snap(spark, rows), path, at, "employee_id", buckets=4, **options)
    want = in_memory(spark, snaps, **options)
    assert rows_of(scd2_store.read(spark, path), *want.columns) == rows_of(want)
    assert scd2_store.row_count(spark, path, TIMES[2]) == want.count()
    first = scd2_store.read(spark, path, TIMES[0])  # as it was
    assert first.filter("is_current").count() == first.count() == len(snaps[0])
    assert rows_of(scd2_store.current(spark, path, TIMES[2]), "employee_id") == rows_of(want.filter("is_current"), "employee_id")


def test_a_run_writes_only_the_buckets_that_change(spark):
    path = shared_dir(spark, "scd2")
    rows = [(k, 1, 10) for k in range(200)]
    first = scd2_store.apply_run(snap(spark, rows), path, TIMES[0], "employee_id", buckets=16)
    files = set(spark.read.parquet(path).inputFiles())
    same = scd2_store.apply_run(snap(spark, rows), path, TIMES[1], "employee_id")
    one = scd2_store.apply_run(snap(spark, [(0, 1, 11), *rows[1:]]), path, TIMES[2], "employee_id")
    assert (first.rows, len(first.buckets), same.rows, same.buckets) == (200, 16, 0, ())
    assert len(one.buckets) == 1 and one.rows < 40
    assert files <= set(spark.read.parquet(path).inputFiles())  # history files are left alone
    assert scd2_store.read(spark, path).count() == 201 and scd2_store.read(spark, path, TIMES[1]).count() == 200


def test_digest_tells_swapped_nulls_apart(spark):
    path = shared_dir(spark, "scd2")
    ddl, cols = "k INT, a INT, b INT", ("a", "b")
    for at, row in ((TIMES[0], (1, None, 5)), (TIMES[1], (1, 5, None))):
        scd2_store.apply_run(spark.createDataFrame([row], ddl), path, at, "k", cols, null_safe=True, buckets=2)
    assert scd2_store.read(spark, path).count() == 2


# --- latest state

def test_state_equals_a_ranking_of_all_history(spark):
    r, bronze, state = random.Random(8), shared_dir(spark, "bronze"), shared_dir(spark, "state")
    keys = [*range(30), None]
    for step in range(8):
        run = f"r{r.randrange(5)}" if step > 3 else f"r{step}"  # new and repeated runs
        rows = [(r.choice(keys), f"{step}-{i}") for i in range(r.randrange(0, 12))]
        df = spark.createDataFrame(rows, "id INT, v STRING")
        if step >= 6:
            df = df.withColumn("extra", F.lit(step))
        ingest_bronze(df, run, TIMES[r.randrange(6)], bronze, source_file=False)
        if step in (1, 4):
            continue  # appended, not folded
        got = latest_state.fold(spark, bronze, state, "id", buckets=4)
        want = latest_from_bronze(read_bronze(spark, bronze), "id")
        assert rows_of(got, *want.columns) == rows_of(want), step
    assert rows_of(latest_state.read(spark, state), *want.columns) == rows_of(want)
    with pytest.raises(FileNotFoundError):
        latest_state.read(spark, shared_dir(spark, "none"))


def test_a_fold_reads_and_writes_only_what_is_new(spark):
    bronze, state = shared_dir(spark, "bronze"), shared_dir(spark, "state")
    ingest_bronze(spark.range(500), "r1", TIMES[0], bronze, source_file=False)
    latest_state.fold(spark, bronze, state, "id", buckets=16)
    ingest_bronze(spark.range(3), "r2", TIMES[1], bronze, source_file=False)
    latest_state.fold(spark, bronze, state, "id", buckets=16)
    gens = [g for g, _ in runs.listed(spark, state, latest_state.GEN, latest_state.BUCKET)]
    assert gens.count("0000000001") == 16 and 1 <= gens.count("0000000002") <= 3
    latest_state.fold(spark, bronze, state, "id", buckets=16)  # nothing new
    assert runs.labels(spark, state, latest_state.GEN)[-1] == "0000000002"


def test_a_fold_that_stopped_half_way_is_repeated(spark, monkeypatch):
    bronze, state = shared_dir(spark, "bronze"), shared_dir(spark, "state")
    ingest_bronze(spark.range(20), "r1", TIMES[0], bronze, source_file=False)
    latest_state.fold(spark, bronze, state, "id", buckets=4)
    ingest_bronze(spark.range(10, 40), "r2", TIMES[1], bronze, source_file=False)
    monkeypatch.setattr(latest_state, "_record", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        latest_state.fold(spark, bronze, state, "id", buckets=4)  # rows written, not recorded
    assert latest_state.read(spark, state).count() == 20  # still the last complete fold
    monkeypatch.undo()
    got = latest_state.fold(spark, bronze, state, "id", buckets=4)
    assert {x._run_id: x["count"] for x in got.groupBy("_run_id").count().collect()} == {"r1": 10, "r2": 30}


def test_a_key_whose_only_run_went_missing_is_gone(spark):
    bronze, state = shared_dir(spark, "bronze"), shared_dir(spark, "state")
    ingest_bronze(spark.range(5), "r1", TIMES[0], bronze, source_file=False)
    ingest_bronze(spark.range(3, 8), "r2", TIMES[1], bronze, source_file=False)
    latest_state.fold(spark, bronze, state, "id", buckets=4)
    ingest_bronze(spark.range(0), "r2", TIMES[1], bronze, source_file=False)
    assert rows_of(latest_state.fold(spark, bronze, state, "id", buckets=4), "id", "_run_id") == [f"({i}, 'r1')" for i in range(5)]


# --- landed text

def test_landed_lines_split_and_keep_their_text(spark):
    texts = ["a\nb", "c\r\nd", "back\\", 'q "x", y', "100%", "%0A %25", "\\n", "é ü", "plain", None, "end\n"]
    df = spark.createDataFrame([(i, texts[i % len(texts)]) for i in range(2000)], "id INT, txt STRING").coalesce(1)
    folder = land_csv(df, shared_dir(spark, "raw"), "t", "2026-05-21", file_rows=700)
    had = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        back = read_landed(spark, folder, schema="id INT, txt STRING", with_source_file=True)
        assert back.rdd.getNumPartitions() > 4  # several tasks for one entity
        assert sorted((r.id, r.txt) for r in back.collect()) == [(i, texts[i % len(texts)]) for i in range(2000)]
        assert back.select("_source_file").distinct().count() == 3  # files of bounded rows
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", had)


def test_foreign_files_stay_as_they_are(spark, tmp_path):
    (tmp_path / "day").mkdir()
    (tmp_path / "day" / "m.csv").write_text('id,txt\n1,"line one\nline %0A two"\n2,plain\n')
    got = read_landed(spark, str(tmp_path / "day"), schema="id INT, txt STRING").collect()
    assert [(r.id, r.txt) for r in got] == [(1, "line one\nline %0A two"), (2, "plain")]
    ingested = ingest_bronze(read_landed(spark, land_csv(spark.range(2).withColumn("t", F.lit("x")), str(tmp_path), "e", "d"),
                                         schema="id INT, t STRING"), "r1", TIMES[0])
    assert ingested.filter("_source_file LIKE '%/e/d/%'").count() == 2  # file metadata survives the spelling


# --- failed steps

def lake(spark, base, date, pay=1000):
    day = f"{base}/raw"
    land_csv(spark.createDataFrame([(1, "E1", "2026-05-20", "Present", "2026-05-20 09:00:00", "2026-05-20 17:30:00")],
             "attendance_id INT, employee_id STRING, attendance_date STRING, attendance_status STRING, check_in_time STRING, "
             "check_out_time STRING"), day, "attendance", date)
    land_csv(spark.createDataFrame([(1, "E1", "2026-05-01", f"{pay}", "1", "1", f"{pay}", "2026-05-31")],
             "payroll_id INT, employee_id STRING, pay_period STRING, basic_salary STRING, bonus_amount STRING, "
             "deduction_amount STRING, net_pay STRING, processed_date STRING"), day, "payroll", date)
    land_csv(spark.createDataFrame([("E1", "D1", "Eng", "M", "100.00", "Active", "2020-01-01")],
             "employee_id STRING, department_id STRING, designation STRING, manager_id STRING, salary STRING, "
             "employment_status STRING, hire_date STRING"), day, "employee", date)
    land_csv(spark.createDataFrame([("D1", "One", "BU", "L", "Y", "2026-05-01")], "department_id STRING, department_name STRING, "
             "business_unit STRING, location STRING, active_status STRING, last_updated STRING"), day, "department", date)


def test_what_needs_a_failed_step_is_skipped_and_reports_keep_the_last_run(spark, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter

    from strata.plans import orchestrate

    base, sent, sql = shared_dir(spark, "lake"), [], []
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, url, table, mode=None, properties=None: sent.append((table, self._df.count())))
    params = lambda run, day: orchestrate.RunParams(
        base, run, day, f"{day} 23:00:00", n_months=3, buckets=2, jdbc_url="jdbc:x", execute=lambda s: sql.append(list(s)),
        clock=lambda: dt.datetime(2026, 5, 21, 6))
    lake(spark, base, "2026-05-20")
    outcomes, audit = orchestrate.run_all(spark, params("r1", "2026-05-20"))
    assert {o.status for o in outcomes} == {"SUCCESS"} and audit.first().records_read == 3
    assert any("rpt_attendance_payroll" in t for t, _ in sent) and len([s for s in sql if s[0].startswith("DELETE")]) == 4
    lake(spark, base, "2026-05-21", pay=2000)
    sent.clear(), sql.clear()

    def broken(spark, p):
        raise RuntimeError("no payroll today")

    monkeypatch.setattr(orchestrate, "silver_payroll", broken)
    outcomes, audit = orchestrate.run_all(spark, params("r2", "2026-05-21"), raise_on_failure=False)
    status = {o.table: o.status for o in outcomes}
    assert status["silver_payroll"] == "FAILED"
    assert status["gold_attendance_payroll"] == status["publish_attendance_payroll"] == "SKIPPED"
    assert status["gold_workforce_summary"] == status["publish_workforce_summary"] == "SUCCESS"
    gold = f"{base}/gold/attendance_payroll"
    assert snapshots.latest_label(spark, gold) == "2026-05-20 23:00:00" and snapshots.read_partition(spark, gold).count() == 1
    assert not any("rpt_attendance_payroll" in t for t, _ in sent) and not any("rpt_attendance_payroll" in x for s in sql for x in s)
    a = audit.first()
    assert (a.records_read, a.records_rejected, a.status) == (2, 0, "PartialFailure")  # the failed table counts 0
    assert a.error_message == "Failed notebooks: silver_payroll; skipped: gold_attendance_payroll, publish_attendance_payroll"
    monkeypatch.undo()
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, url, table, mode=None, properties=None: None)
    outcomes, audit = orchestrate.run_all(spark, params("r2", "2026-05-21"))  # repaired and run again
    assert audit.first().records_read == 3 and snapshots.read_partition(spark, gold).count() == 1
    assert spark.read.parquet(f"{base}/audit").count() == 2  # one row per run, also after a re-run

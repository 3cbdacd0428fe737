"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator key.

Every query reads whole test tables (or tables Spark derives from them);
queries that write (partitions, CSV, bronze) use a fresh folder under the
session's shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.operators import gold, latest_state, runs, scd2, scd2_store, snapshots
from strata.operators.audit import audit_row, counted
from strata.functions.columns import typed_timestamp
from strata.operators.bronze import append_run, ingest_bronze, latest_from_bronze, read_bronze, stored_runs
from strata.operators.dedupe import latest_by, split_duplicates
from strata.operators.quality import add_work_hours, attendance_flags, cast_or_reject, variance_profile
from strata.plans.standins import (
    AS_OF,
    AS_OF_POINT,
    ATT_REJECT_COLS,
    END_TIME,
    INGEST_TS,
    N_MONTHS,
    START_TIME,
    T0,
    T1,
    T2,
    TRACKED,
    StandIns,
)
from strata.streaming.ingest import ingest_available
from strata.session import shared_dir
from strata.sources.files import footer_rows, land_csv, read_landed, read_table, write_table

Query = Callable[[SparkSession, str], DataFrame]

BUCKETS = 8  # of stored state tables: the test tables are small, and every bucket is a file

ATT_CLEAN_COLS = ["attendance_id", "employee_id", "attendance_date", "attendance_status", "check_in_time",
                  "check_out_time", "_ingest_ts", "_run_id", "check_in_ts", "check_out_ts", "work_hours",
                  "dq_status_with_times", "dq_excess_hours"]
PAY_CLEAN_COLS = ["payroll_id", "employee_id", "pay_period", "basic_salary", "bonus_amount", "deduction_amount",
                  "net_pay", "processed_date", "_ingest_ts", "_run_id", "net_pay_raw", "net_pay_corrected",
                  "net_pay_variance", "pay_period_end", "payroll_delay_days", "dq_future_processing"]


def _s(spark, d) -> StandIns:
    return StandIns(spark, d)


def q_dedupe_clean(spark, d):
    clean, _ = _s(spark, d).attendance_split
    return clean.select(*ATT_CLEAN_COLS)


def q_dedupe_rejected(spark, d):
    _, rejected = _s(spark, d).attendance_split
    return rejected


def q_work_hours(spark, d):
    return _s(spark, d).attendance_enriched.select("attendance_id", "check_in_ts", "check_out_ts", "work_hours")


def q_dq_flags(spark, d):
    return _s(spark, d).attendance_enriched.select(
        "attendance_id", "attendance_status", "work_hours", "dq_status_with_times", "dq_excess_hours"
    )


def q_row_metrics(spark, d):
    s = _s(spark, d)
    clean, rejected = s.attendance_split
    flagged = F.col("dq_status_with_times").isNotNull() | F.col("dq_excess_hours").isNotNull()
    marks = clean.select(F.lit(1).alias("c"), F.lit(0).alias("r"), flagged.cast("int").alias("f")).unionByName(
        rejected.select(F.lit(0).alias("c"), F.lit(1).alias("r"), F.lit(0).alias("f"))
    )
    return marks.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.sum("c").cast("bigint").alias("clean"),
        F.sum("r").cast("bigint").alias("rejected"),
        F.sum("f").cast("bigint").alias("flagged"),
    )


def q_preview_attendance(spark, d):
    clean, _ = _s(spark, d).attendance_split
    return gold.top_n(
        clean.select("attendance_id", "employee_id", "attendance_date", "attendance_status", "work_hours"),
        [F.col("employee_id"), F.col("attendance_date")], 20,
    )


def q_net_pay_corrected(spark, d):
    return _s(spark, d).payroll_enriched.select("payroll_id", "net_pay_raw", "net_pay_corrected", "net_pay_variance")


def q_payroll_delay(spark, d):
    return _s(spark, d).payroll_enriched.select(
        "payroll_id", "pay_period", "processed_date", "pay_period_end", "payroll_delay_days"
    )


def q_dq_future_processing(spark, d):
    return _s(spark, d).payroll_enriched.select("payroll_id", "payroll_delay_days", "dq_future_processing")


def q_variance_profile(spark, d):
    return variance_profile(_s(spark, d).payroll_enriched)


def q_payroll_clean(spark, d):
    clean, _ = _s(spark, d).payroll_split
    return clean.select(*PAY_CLEAN_COLS)


def q_payroll_rejected(spark, d):
    _, rejected = _s(spark, d).payroll_split
    return rejected


def q_monthly_status_counts(spark, d):
    return _s(spark, d).monthly_counts


def q_attendance_payroll(spark, d):
    return _s(spark, d).attendance_payroll()


def q_latest_by(spark, d):
    s = _s(spark, d)
    return latest_by(s.table("orders"), ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")], tiebreak=[])


def q_scd2_init(spark, d):
    return _s(spark, d).employee_v0


def q_scd2_changes(spark, d):
    s = _s(spark, d)
    return scd2.scd2_changes(s.employee_v0, s.employee_incoming, "employee_id", TRACKED)


def q_scd2_new_keys(spark, d):
    s = _s(spark, d)
    return scd2.scd2_new_keys(s.employee_v0, s.employee_incoming, "employee_id")


def q_scd2_expire(spark, d):
    s = _s(spark, d)
    changed = scd2.scd2_changes(s.employee_v0, s.employee_incoming, "employee_id", TRACKED)
    return scd2.scd2_expire(s.employee_v0, changed, "employee_id", T1)


def q_scd2_apply(spark, d):
    return _s(spark, d).employee_versions


def q_scd2_apply_null_safe(spark, d):
    return _s(spark, d).employee_v1(null_safe=True)


def q_scd2_as_of(spark, d):
    return scd2.scd2_as_of(_s(spark, d).employee_versions, AS_OF_POINT)


def q_month_spine(spark, d):
    """The 48 months ending with the latest order month (read from the whole ``orders`` table)."""
    return gold.month_spine_from(_s(spark, d).table("orders"), "o_orderdate", N_MONTHS)


def q_headcount_history(spark, d):
    return _s(spark, d).headcount("range_join")


def q_headcount_history_expanded(spark, d):
    return _s(spark, d).headcount("expand")


def q_headcount_history_sweep(spark, d):
    return _s(spark, d).headcount("sweep")


def q_sorted_history(spark, d):
    return _s(spark, d).headcount("expand").orderBy("snapshot_month", "department_id")


def q_workforce_summary(spark, d):
    return _s(spark, d).workforce()


def q_top_attrition(spark, d):
    return gold.top_n(_s(spark, d).workforce(), [F.desc("attrition_count"), F.asc("department_id")], 5)


def q_status_breakdown(spark, d):
    return gold.status_breakdown(_s(spark, d).employee_versions)


def _versioned_employee(spark, d) -> str:
    """The employee table at two versions, one partition ``version=`` each."""
    s = _s(spark, d)
    path = shared_dir(spark, "employee_versions")
    snapshots.write_partition(s.employee_v0, path, 0, "version")
    v0 = snapshots.read_partition(spark, path, "0", "version")
    v1 = scd2.scd2_apply(v0, s.employee_incoming, "employee_id", T1, tracked=TRACKED)
    snapshots.write_partition(v1, path, 1, "version")
    return path


def q_status_breakdown_sql(spark, d):
    """Current rows per status through Spark SQL text over the stored latest version."""
    path = _versioned_employee(spark, d)
    return spark.sql(f"SELECT employment_status, COUNT(*) AS cnt FROM parquet.`{path}` "
                     "WHERE version = 1 AND is_current = true GROUP BY employment_status")


def q_compare_versions(spark, d):
    path = _versioned_employee(spark, d)
    return snapshots.compare_partitions(spark, path, "is_current AND employment_status = 'Active'", "1", "0")


def q_version_history(spark, d):
    """Rows of each stored version: an aggregate over the version column."""
    t = spark.read.parquet(_versioned_employee(spark, d))
    return t.groupBy("version").agg(F.count(F.lit(1)).alias("num_rows"))


def q_read_version(spark, d):
    return spark.read.parquet(_versioned_employee(spark, d)).filter("version = 0")


def q_compact_and_cluster(spark, d):
    """``orders`` rewritten in value ranges, files of about 32 MB by row count."""
    path = shared_dir(spark, "orders_clustered")
    write_table(snapshots.clustered(_s(spark, d).table("orders"), ["o_custkey", "o_orderdate"], 32 << 20, 40), path)
    return read_table(spark, path)


def q_cluster_ranges(spark, d):
    """Files of ``orders`` clustered into many ranges: rows, and neighbours (by their least key) whose ranges overlap."""
    path, key = shared_dir(spark, "orders_ranges"), F.struct("o_custkey", "o_orderdate")
    write_table(snapshots.clustered(_s(spark, d).table("orders"), ["o_custkey", "o_orderdate"], 64 << 10, 40), path)
    files = read_table(spark, path).groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(key).alias("low"), F.max(key).alias("high"), F.count(F.lit(1)).alias("n"))
    # one row per file: the number of files follows the table's bytes
    apart = files.withColumn("before", F.max("high").over(Window.orderBy("low", "high", "file").rowsBetween(Window.unboundedPreceding, -1)))
    return apart.agg(F.sum("n").alias("rows"), F.count_if(F.col("before") > F.col("low")).alias("overlaps"),
                     F.least(F.count(F.lit(1)), F.lit(2)).alias("files_up_to_two"))


ORDERS_MAPPING = [
    ("o_orderkey", "o_orderkey", "bigint"),
    ("o_custkey", "o_custkey", "bigint"),
    ("o_orderstatus", "o_orderstatus", "string"),
    ("o_totalprice", "o_totalprice", "double"),
    ("o_orderdate", "o_orderdate", "string"),
    ("o_orderpriority", "o_orderpriority", "string"),
]
ORDERS_LANDED_SCHEMA = ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
                        "o_orderdate STRING, o_orderpriority STRING")


def q_csv_roundtrip(spark, d):
    o = _s(spark, d).table("orders")
    folder = land_csv(o, shared_dir(spark, "raw"), "orders", "2024-02-01", ORDERS_MAPPING)
    return read_landed(spark, folder, schema=ORDERS_LANDED_SCHEMA)


EVENTS_SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def _landed(col: str = "_source_file"):
    """The landing-folder part of a source file: ``<entity>/<date>``."""
    return F.regexp_extract(col, r"([^/]+/[0-9-]+)/[^/]+$", 1).alias("landed")


def q_bronze_append(spark, d):
    """Two runs of one landed file, the second run twice: every row of Bronze, with its lineage."""
    ev = _s(spark, d).table("events")
    raw = land_csv(ev, shared_dir(spark, "raw"), "events", "2024-02-01")
    bronze = shared_dir(spark, "bronze_events")
    for run in ("001", "r2", "r2"):  # r2 twice: the re-run replaces its own partition
        ingest_bronze(read_landed(spark, raw, schema=EVENTS_SCHEMA), run, INGEST_TS, bronze)
    return read_bronze(spark, bronze).select("event_id", "ts", "user_id", "event_type", "value", "props", "_ingest_ts",
                                             _landed(), "_run_id")


def q_csv_inferred(spark, d):
    """``orders`` landed as CSV and read back with inferred types."""
    folder = land_csv(_s(spark, d).table("orders"), shared_dir(spark, "raw"), "orders", "2024-02-01")
    return read_landed(spark, folder, infer=True).select(
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"), F.col("o_custkey").cast("bigint").alias("o_custkey"),
        "o_orderstatus", "o_totalprice", F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_orderpriority")


def _ingest_orders(spark, d, bronze: str, ingests) -> None:
    """Runs of (run id, ingest time, which rows, added to the price) of ``orders``, in the order they are appended."""
    o = _s(spark, d).table("orders")
    for run, ts, only, plus in ingests:
        rows = o if only is None else o.filter(only)
        ingest_bronze(rows.withColumn("o_totalprice", F.col("o_totalprice") + F.lit(plus)), run, ts, bronze, source_file=False)


def _latest_orders(spark, d, *folds) -> DataFrame:
    """Latest orders kept incrementally: after each group of ingests the state folds in what is new or changed."""
    bronze, state = shared_dir(spark, "bronze_orders"), shared_dir(spark, "latest_orders")
    for ingests in folds:
        _ingest_orders(spark, d, bronze, ingests)
        out = latest_state.fold(spark, bronze, state, "o_orderkey", buckets=BUCKETS)
    return out.drop("_source_file")


def q_latest_incremental(spark, d):
    """``orders`` ingested twice: run r1 = orders placed before T0, run r2 = every order again with a corrected price."""
    early = F.col("o_orderdate") < typed_timestamp(T0)
    return _latest_orders(spark, d, [("r1", T0, early, 0.0)], [("r2", T1, None, 100.0)])


def q_latest_skipped_run(spark, d):
    """r1 and r3 were processed, r2 only appended: its orders count all the same."""
    early = F.col("o_orderdate") < typed_timestamp(T0)
    return _latest_orders(spark, d, [("r1", T0, early, 0.0)], [("r2", T1, ~early, 50.0), ("r3", T2, early, 100.0)])


def q_latest_rerun(spark, d):
    """r1 is run again with a corrected file after r2, which holds the later orders only."""
    early = F.col("o_orderdate") < typed_timestamp(T0)
    return _latest_orders(spark, d, [("r1", T0, None, 0.0)], [("r2", T1, ~early, 50.0)], [("r1", T0, early, 25.0)])


def q_latest_late_run(spark, d):
    """A run with an earlier ingest time arrives last: it changes only orders that no other run has."""
    early = F.col("o_orderdate") < typed_timestamp(T0)
    return _latest_orders(spark, d, [("r2", T1, ~early, 50.0)], [("r1", T0, None, 0.0)])


def q_latest_ranked(spark, d):
    """The same pick by one ranking of the whole history (no state): three runs, the first one empty in the end."""
    early, bronze = F.col("o_orderdate") < typed_timestamp(T0), shared_dir(spark, "bronze_orders")
    _ingest_orders(spark, d, bronze, [("r1", T2, None, 7.0), ("r2", T0, None, 0.0), ("r3", T1, early, 50.0), ("r1", T2, F.lit(False), 7.0)])
    return latest_from_bronze(read_bronze(spark, bronze), "o_orderkey").drop("_source_file")


def q_empty_rerun(spark, d):
    """Two runs; the second is run again and delivers nothing: its rows are gone, the first run's stay."""
    bronze = shared_dir(spark, "bronze_orders")
    _ingest_orders(spark, d, bronze, [("r1", T0, None, 0.0), ("r2", T1, None, 1.0), ("r2", T1, F.lit(False), 0.0)])
    return read_bronze(spark, bronze).drop("_source_file", "_ingest_ts")


def q_runs_summary(spark, d):
    """Rows per run of a stored history from file footers, in run order; the second run was emptied."""
    early, bronze = F.col("o_orderdate") < typed_timestamp(T0), shared_dir(spark, "bronze_orders")
    _ingest_orders(spark, d, bronze, [("003", T2, None, 0.0), ("001", T0, early, 0.0), ("002", T1, None, 0.0), ("002", T1, F.lit(False), 0.0)])
    return stored_runs(spark, bronze)


def q_footer_counts(spark, d):
    """Rows and key range of ``lineitem`` per return flag, one stored folder each, from footers."""
    path = shared_dir(spark, "lineitem_flags")
    _s(spark, d).table("lineitem").select("l_orderkey", "l_returnflag").write.partitionBy("l_returnflag").parquet(path)
    return footer_rows(spark, path, ("l_returnflag",), ("l_orderkey",))


def _typed_events(spark, d):
    ev = _s(spark, d).table("events").select("event_id", F.col("value").cast("string").alias("value"))
    return cast_or_reject(ev, {"value": "decimal(4,2)"}, reason="bad_value")


def q_typed_values(spark, d):
    """Strict typing (text -> decimal(4,2)) of every event value: the rows that fit."""
    typed, _ = _typed_events(spark, d)
    return typed


def q_bad_values(spark, d):
    """... and the rows that do not (values of 100 and more), kept with the reason."""
    _, bad = _typed_events(spark, d)
    return bad


def q_schema_evolution(spark, d):
    c = _s(spark, d).table("customer")
    bronze = shared_dir(spark, "bronze_customer")
    ingest_bronze(c.drop("c_mktsegment"), "r1", INGEST_TS, bronze)
    ingest_bronze(c, "r2", INGEST_TS, bronze)
    return read_bronze(spark, bronze).select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment", "_run_id")


def q_audit_row(spark, d):
    """The audit row of a run that wrote three silver and two rejected tables: counts observed in the writes."""
    s, path = _s(spark, d), shared_dir(spark, "audited")
    clean, rejected = {}, {}
    for name, (good, bad) in (("attendance", s.attendance_split), ("payroll", s.payroll_split)):
        clean[name] = runs.write_run(good, f"{path}/silver_{name}", "r1", "_run")
        rejected[name] = runs.write_run(bad, f"{path}/rejected_{name}", "r1", "_run")
    clean["employee"] = runs.write_run(s.employee_versions, f"{path}/silver_employee", "r1", "_run")
    return audit_row(counted(spark, clean, rejected), "r1", START_TIME, END_TIME)


def q_stream_ingest(spark, d):
    """Two landing days, one availableNow run after each: every row of every file once, with its lineage."""
    ev = _s(spark, d).table("events")
    raw = shared_dir(spark, "raw_stream")
    bronze = shared_dir(spark, "bronze_stream")
    ckpt = shared_dir(spark, "stream_ckpt")
    for run, day in (("r1", "2024-02-01"), ("r2", "2024-02-02")):
        land_csv(ev, raw, "events", day)
        ingest_available(spark, raw, EVENTS_SCHEMA, bronze, ckpt, run, INGEST_TS)
    return read_bronze(spark, bronze).select("event_id", "ts", "user_id", "event_type", "value", "props", _landed(), "_run_id")


def q_silver_reingested(spark, d):
    """Silver attendance over ids ingested up to three times: only each id's last ingest takes part."""
    s = _s(spark, d)
    bronze = shared_dir(spark, "bronze_attendance")
    base = s.attendance_bronze.drop("_ingest_ts", "_run_id")
    absent = F.col("attendance_status") == "Absent"
    ingest_bronze(base, "r1", T0, bronze, source_file=False)
    ingest_bronze(base.filter(~absent).withColumn("attendance_status", F.lit("Absent")), "r2", T1, bronze, source_file=False)
    ingest_bronze(base.filter(F.col("attendance_status") == "Leave"), "r3", T2, bronze, source_file=False)
    latest = latest_from_bronze(read_bronze(spark, bronze), "attendance_id")
    clean, _ = split_duplicates(attendance_flags(add_work_hours(latest)), ["employee_id", "attendance_date"],
                                [F.desc("attendance_id")], "duplicate_attendance")
    return clean.select("attendance_id", "employee_id", "attendance_date", "attendance_status", "_run_id", "work_hours",
                        "dq_status_with_times")


def q_rejected_append(spark, d):
    """Rejected attendance appended by two runs, the second run twice."""
    _, rejected = _s(spark, d).attendance_split
    path = shared_dir(spark, "rejected_attendance")
    for run in ("r1", "r2", "r2"):
        append_run(rejected.withColumnRenamed("_run_id", "_ingest_run_id"), path, run)
    return read_bronze(spark, path).select(*ATT_REJECT_COLS, "_ingest_run_id")


def q_table_overwrite(spark, d):
    """A table overwritten with other rows and another schema: only the second write is left."""
    s, path = _s(spark, d), shared_dir(spark, "orders_table")
    write_table(s.table("orders"), path)
    write_table(s.table("customer").select("c_custkey", "c_name"), path)
    return read_table(spark, path)


def q_attendance_payroll_text_month(spark, d):
    """The report over payroll whose period is text ``yyyy-MM`` or any day of the month."""
    s = _s(spark, d)
    last_day = F.pmod(F.month("pay_period"), F.lit(2)) == 0
    pay = s.payroll_silver.withColumn("pay_period", F.when(last_day, F.last_day("pay_period").cast("string")).otherwise(
        F.date_format("pay_period", "yyyy-MM")))
    return gold.attendance_payroll(pay, s.monthly_counts, AS_OF)


def q_headcount_zero_filled(spark, d):
    return gold.headcount_history(_s(spark, d).employee_versions, spark, AS_OF, N_MONTHS, plan="sweep", zero_fill=True)


def _tracked_employee(spark, d, null_safe: bool, wrong_first: bool = False) -> DataFrame:
    """Three runs of the stored type-2 table with history, NULL keys and a manager, read back after the third.

    ``wrong_first``: the second run is made three times: from a snapshot whose
    salaries are all wrong (every open row closes), from none, then from the right one.
    """
    s, path = _s(spark, d), shared_dir(spark, "employee_scd2")
    for at in (T0, T1, T2):
        snap = s.tracked_snapshot(at)
        if wrong_first and at == T1:
            scd2_store.apply_run(snap.withColumn("salary", (F.col("salary") + 1).cast("decimal(18,2)")), path, at, "employee_id", buckets=BUCKETS)
            scd2_store.apply_run(snap.filter(F.lit(False)), path, at, "employee_id", buckets=BUCKETS)
        scd2_store.apply_run(snap, path, at, "employee_id", null_safe=null_safe, buckets=BUCKETS)
    return scd2_store.read(spark, path, T2)


def q_scd2_corrected_rerun(spark, d):
    return _tracked_employee(spark, d, null_safe=False, wrong_first=True)


def q_scd2_history(spark, d):
    return _tracked_employee(spark, d, null_safe=False)


def q_scd2_history_null_safe(spark, d):
    return _tracked_employee(spark, d, null_safe=True)


QUERIES: dict[str, Query] = {
    "workforce_summary": q_workforce_summary,
    "dedupe_clean": q_dedupe_clean,
    "dedupe_rejected": q_dedupe_rejected,
    "work_hours": q_work_hours,
    "dq_flags": q_dq_flags,
    "row_metrics": q_row_metrics,
    "preview_attendance": q_preview_attendance,
    "net_pay_corrected": q_net_pay_corrected,
    "payroll_delay": q_payroll_delay,
    "dq_future_processing": q_dq_future_processing,
    "variance_profile": q_variance_profile,
    "payroll_clean": q_payroll_clean,
    "payroll_rejected": q_payroll_rejected,
    "monthly_status_counts": q_monthly_status_counts,
    "attendance_payroll": q_attendance_payroll,
    "latest_by": q_latest_by,
    "scd2_init": q_scd2_init,
    "scd2_changes": q_scd2_changes,
    "scd2_new_keys": q_scd2_new_keys,
    "scd2_expire": q_scd2_expire,
    "scd2_apply": q_scd2_apply,
    "scd2_apply_null_safe": q_scd2_apply_null_safe,
    "scd2_as_of": q_scd2_as_of,
    "month_spine": q_month_spine,
    "headcount_history": q_headcount_history,
    "headcount_history_expanded": q_headcount_history_expanded,
    "headcount_history_sweep": q_headcount_history_sweep,
    "sorted_history": q_sorted_history,
    "top_attrition": q_top_attrition,
    "status_breakdown": q_status_breakdown,
    "status_breakdown_sql": q_status_breakdown_sql,
    "compare_versions": q_compare_versions,
    "version_history": q_version_history,
    "read_version": q_read_version,
    "compact_and_cluster": q_compact_and_cluster,
    "cluster_ranges": q_cluster_ranges,
    "csv_roundtrip": q_csv_roundtrip,
    "bronze_append": q_bronze_append,
    "schema_evolution": q_schema_evolution,
    "latest_incremental": q_latest_incremental,
    "typed_values": q_typed_values,
    "bad_values": q_bad_values,
    "audit_row": q_audit_row,
    "stream_ingest": q_stream_ingest,
    "csv_inferred": q_csv_inferred,
    "latest_skipped_run": q_latest_skipped_run,
    "latest_rerun": q_latest_rerun,
    "latest_late_run": q_latest_late_run,
    "silver_reingested": q_silver_reingested,
    "rejected_append": q_rejected_append,
    "table_overwrite": q_table_overwrite,
    "attendance_payroll_text_month": q_attendance_payroll_text_month,
    "headcount_zero_filled": q_headcount_zero_filled,
    "latest_ranked": q_latest_ranked,
    "empty_rerun": q_empty_rerun,
    "runs_summary": q_runs_summary,
    "footer_counts": q_footer_counts,
    "scd2_corrected_rerun": q_scd2_corrected_rerun,
    "scd2_history": q_scd2_history,
    "scd2_history_null_safe": q_scd2_history_null_safe,
}

"""SCD2 semantics (FIXTURES.md keys 1-8 + NULL) and the gold reports."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strata.operators import gold, scd2

T0 = "2026-01-01 00:00:00"
T1 = "2026-02-01 00:00:00"
EMP = ("employee_id STRING, department_id STRING, designation STRING, manager_id STRING, salary DECIMAL(18,2), "
       "employment_status STRING, employee_name STRING")
TBL = EMP + ", effective_from TIMESTAMP_NTZ, effective_to TIMESTAMP_NTZ, is_current BOOLEAN"
d = dt.datetime


@pytest.fixture(scope="module")
def table(spark):
    rows = [
        ("1", "A", "x", "m", Decimal(1), "Active", "n1", d(2026, 1, 1), None, True),
        ("2", "B", "x", "m", Decimal(2), "Active", "n2", d(2026, 1, 1), None, True),
        ("3", "C", "x", "m", None, "Active", "n3", d(2026, 1, 1), None, True),
        ("4", "D", "x", "m", Decimal(4), "Active", "n4", d(2025, 6, 1), d(2026, 1, 1), False),
        ("4", "D", "x", "m", Decimal(5), "Active", "n4", d(2026, 1, 1), None, True),
        ("5", "E", "x", "m", Decimal(5), "Active", "n5", d(2026, 1, 1), None, True),
        ("6", "F", "x", "m", Decimal(6), "Active", "n6", d(2025, 6, 1), d(2026, 1, 1), False),
        ("8", "H", "x", "m", Decimal(8), "Active", "old", d(2026, 1, 1), None, True),
    ]
    return spark.createDataFrame(rows, TBL)


@pytest.fixture(scope="module")
def incoming(spark):
    rows = [
        ("1", "A", "x", "m", Decimal(1), "Active", "n1"),
        ("2", "BB", "x", "m", Decimal(2), "Active", "n2"),
        ("3", "C", "x", "m", Decimal(9), "Active", "n3"),
        ("4", "D", "x", "m", Decimal(6), "Active", "n4"),
        ("6", "F", "x", "m", Decimal(6), "Active", "n6"),
        ("7", "G", "x", "m", Decimal(7), "Active", "n7"),
        (None, "N", "x", "m", Decimal(0), "Active", "nn"),
        ("8", "H", "x", "m", Decimal(8), "Active", "new name"),
    ]
    return spark.createDataFrame(rows, EMP)


def by_key(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.employee_id, []).append(r)
    return out


def test_apply_parity(table, incoming):
    v = by_key(scd2.scd2_apply(table, incoming, "employee_id", T1))
    assert len(v["1"]) == 1 and v["1"][0].is_current
    k2 = sorted(v["2"], key=lambda r: r.effective_from)
    assert [r.is_current for r in k2] == [False, True]
    assert k2[0].effective_to == d(2026, 2, 1) == k2[1].effective_from  # one as_of closes and opens
    assert len(v["3"]) == 1  # Q1: NULL -> value is not a change in parity
    assert sorted((r.salary, r.is_current) for r in v["4"]) == [(4, False), (5, False), (6, True)]
    assert len(v["5"]) == 1 and v["5"][0].is_current  # Q3: missing stays current
    assert sorted(r.is_current for r in v["6"]) == [False, True]  # Q4: re-enters as new
    assert len(v["7"]) == 1 and v["7"][0].effective_from == d(2026, 2, 1)
    assert len(v[None]) == 1  # Q6: NULL key inserted
    assert len(v["8"]) == 1 and v["8"][0].employee_name == "old"  # Q5: untracked column not refreshed


def test_apply_null_safe_and_options(table, incoming):
    v = by_key(scd2.scd2_apply(table, incoming, "employee_id", T1, null_safe=True))
    assert sorted(r.is_current for r in v["3"]) == [False, True]
    v = by_key(scd2.scd2_apply(table, incoming, "employee_id", T1, close_missing=True, null_keys="reject"))
    assert [r.is_current for r in v["5"]] == [False]
    assert None not in v


def test_apply_is_idempotent_and_intervals_do_not_overlap(spark, table, incoming):
    once = scd2.scd2_apply(table, incoming, "employee_id", T1, null_keys="reject")
    twice = scd2.scd2_apply(once, incoming, "employee_id", "2026-03-01 00:00:00", null_keys="reject")
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0
    cur = twice.filter("is_current").groupBy("employee_id").count().filter("count > 1")
    assert cur.count() == 0
    a, b = twice.alias("a"), twice.alias("b")
    overlap = a.join(b, (F.col("a.employee_id") == F.col("b.employee_id"))
                     & (F.col("a.effective_from") < F.col("b.effective_from"))
                     & (F.col("a.effective_to").isNull() | (F.col("a.effective_to") > F.col("b.effective_from"))))
    assert overlap.count() == 0


def test_changes_new_keys_expire(table, incoming):
    ch = {r.employee_id for r in scd2.scd2_changes(table, incoming, "employee_id").collect()}
    assert ch == {"2", "4"}
    nk = {r.employee_id for r in scd2.scd2_new_keys(table, incoming, "employee_id").collect()}
    assert nk == {"6", "7", None}
    exp = scd2.scd2_expire(table, scd2.scd2_changes(table, incoming, "employee_id"), "employee_id", T1)
    assert exp.count() == table.count()
    assert exp.filter("is_current").count() == 4


def test_init_and_as_of(spark, incoming):
    v0 = scd2.scd2_init(incoming, T0)
    assert v0.filter("is_current AND effective_to IS NULL").count() == incoming.count()
    v1 = scd2.scd2_apply(v0, incoming.withColumn("salary", F.col("salary") + 1), "employee_id", T1)
    assert scd2.scd2_as_of(v1, "2026-01-15 00:00:00").count() == incoming.count()
    assert scd2.scd2_as_of(v1, "2025-12-31 00:00:00").count() == 0


VERS = "department_id STRING, employment_status STRING, effective_from TIMESTAMP_NTZ, effective_to TIMESTAMP_NTZ"


@pytest.fixture(scope="module")
def versions(spark):
    rows = [
        ("a", "Active", d(2026, 5, 30, 23, 59, 59), None),
        ("b", "Active", d(2026, 5, 31), None),
        ("c", "Active", d(2026, 5, 31, 9), None),
        ("d", "Active", d(2026, 4, 1), d(2026, 5, 31)),
        ("e", "Active", d(2026, 4, 1), d(2026, 5, 31, 0, 0, 1)),
        ("f", "Resigned", d(2026, 4, 1), None),
        ("g", "Active", d(2024, 1, 15), d(2026, 2, 10)),
    ]
    return spark.createDataFrame(rows, VERS)


@pytest.mark.parametrize("plan", ["expand", "range_join", "sweep"])
def test_headcount_boundaries(spark, versions, plan):
    out = gold.headcount_history(versions, spark, "2026-06-10", 12, plan=plan)
    may = {r.department_id for r in out.filter("snapshot_month = '2026-05'").collect()}
    assert may == {"a", "b", "e"}  # c: 09:00 on the 31st (Q11); d: to == midnight
    g = sorted(r.snapshot_month for r in out.filter("department_id = 'g'").collect())
    assert g == ["2025-07", "2025-08", "2025-09", "2025-10", "2025-11", "2025-12", "2026-01"]


def test_headcount_plans_agree_and_end_of_day(spark, versions):
    a = gold.headcount_history(versions, spark, "2026-08-01", 30, plan="expand")
    b = gold.headcount_history(versions, spark, "2026-08-01", 30, plan="range_join")
    c = gold.headcount_history(versions, spark, "2026-08-01", 30, plan="sweep")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert a.exceptAll(c).count() == 0 and c.exceptAll(a).count() == 0
    nd = versions.withColumn("department_id", F.lit(None).cast("string"))  # NULL department: own group
    x = gold.headcount_history(nd, spark, "2026-08-01", 30, plan="expand")
    y = gold.headcount_history(nd, spark, "2026-08-01", 30, plan="sweep")
    assert x.count() > 0 and x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0
    eod = gold.headcount_history(versions, spark, "2026-06-10", 12, plan="expand", end_of_day=True)
    eod_j = gold.headcount_history(versions, spark, "2026-06-10", 12, plan="range_join", end_of_day=True)
    may = {r.department_id for r in eod.filter("snapshot_month = '2026-05'").collect()}
    assert may == {"a", "b", "c"}  # strict: end of day; d and e now closed before it
    assert eod.exceptAll(eod_j).count() == 0


def test_headcount_plan_shapes(spark, versions):
    plan = gold.headcount_history(versions, spark, "2026-06-10", 12, plan="expand")._jdf.queryExecution()
    s = plan.executedPlan().toString()
    assert "Join" not in s and "Cartesian" not in s
    plan = gold.headcount_history(versions, spark, "2026-06-10", 12, plan="range_join")._jdf.queryExecution()
    s = plan.executedPlan().toString()
    assert "BroadcastHashJoin" in s and "NestedLoop" not in s and "Cartesian" not in s


def test_month_spine(spark):
    rows = [r.snapshot_month for r in gold.month_spine(spark, "2026-05-21", 3).collect()]
    assert rows == ["2026-05", "2026-04", "2026-03"]


def test_workforce_summary_edges(spark):
    emp = spark.createDataFrame(
        [("1", "D1", Decimal("100.00"), "Active", True), ("2", "D1", Decimal("200.01"), "Resigned", True),
         ("3", "D1", None, "Notice", True), ("4", "DX", None, "Leave", True), ("5", None, Decimal(5), None, True),
         ("6", "D1", Decimal(999), "Active", False)],
        "employee_id STRING, department_id STRING, salary DECIMAL(18,2), employment_status STRING, is_current BOOLEAN")
    dept = spark.createDataFrame([("D1", "One"), ("D2", "Empty")], "department_id STRING, department_name STRING")
    out = {r.department_id: r for r in gold.workforce_summary(emp, dept, "2026-05-21").collect()}
    assert set(out) == {"D1", "DX", None}  # empty department absent; unknown and NULL kept
    assert (out["D1"].headcount, out["D1"].active_count, out["D1"].attrition_count) == (3, 1, 2)
    assert out["D1"].avg_salary == Decimal("150.01")  # HALF_UP of 150.005
    assert out["DX"].department_name is None and out["DX"].avg_salary is None


def test_attendance_payroll_normalises_periods(spark):
    att = spark.createDataFrame(
        [("E1", dt.date(2026, 5, 3), "Present"), ("E1", dt.date(2026, 5, 4), "Absent"),
         ("E1", dt.date(2026, 5, 5), "Present"), ("E2", dt.date(2026, 6, 1), "Present")],
        "employee_id STRING, attendance_date DATE, attendance_status STRING")
    pay = spark.createDataFrame(
        [("E1", dt.date(2026, 5, 15), Decimal(1), 2), ("E3", dt.date(2026, 5, 1), Decimal(2), 0)],
        "employee_id STRING, pay_period DATE, net_pay_corrected DECIMAL(18,2), payroll_delay_days INT")
    out = {r.employee_id: r for r in gold.attendance_payroll(pay, gold.monthly_status_counts(att), "2026-07-01").collect()}
    assert (out["E1"].days_present, out["E1"].days_absent) == (2, 1)
    assert (out["E3"].days_present, out["E3"].days_absent) == (0, 0)
    assert out["E1"].pay_period == dt.date(2026, 5, 1)


def test_top_n_and_status_breakdown(spark, table):
    sb = {r.employment_status: r.cnt for r in gold.status_breakdown(table).collect()}
    assert sb == {"Active": 6}
    top = gold.top_n(table, [F.desc("salary"), F.asc("employee_id")], 2).collect()
    assert [r.employee_id for r in top] == ["8", "6"]


def test_month_spine_from_data(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 3, 9, 10),), (dt.datetime(2025, 12, 1),)], "ts TIMESTAMP_NTZ")
    assert [r.snapshot_month for r in gold.month_spine_from(df, "ts", 4).collect()] == [
        "2026-03", "2026-02", "2026-01", "2025-12"]
    assert gold.month_spine_from(df.limit(0), "ts", 4).count() == 0


def test_apply_with_many_null_keys_bypasses_the_join(spark):
    # a third of the table and of the snapshot carry a NULL key
    cur = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id").cast("string")).alias("employee_id"),
        F.lit("D").alias("department_id"), F.lit("x").alias("designation"), F.lit("m").alias("manager_id"),
        F.lit(1).cast("decimal(18,2)").alias("salary"), F.lit("Active").alias("employment_status"),
        F.lit("n").alias("employee_name"))
    from strata.operators.dedupe import stage

    table = stage(scd2.scd2_init(cur, T0), with_row_id=False)
    inc = stage(cur.withColumn("salary", F.when(F.col("employee_id").cast("int") % 2 == 0, F.lit(2))
                               .otherwise(F.col("salary")).cast("decimal(18,2)")), with_row_id=False)
    out = scd2.scd2_apply(table, inc, "employee_id", T1)
    nulls, keyed = 1000, 2000
    changed = inc.filter("CAST(employee_id AS INT) % 2 = 0").count()
    assert out.count() == (nulls + keyed) + nulls + changed  # NULL keys: kept + inserted again (Q6)
    assert out.filter("employee_id IS NOT NULL AND is_current").count() == keyed
    plan = out._jdf.queryExecution().executedPlan().toString()
    join_part = plan[plan.index("SortMergeJoin"):]
    assert "isnotnull(employee_id" in join_part


def test_expire_keeps_rows_with_null_current_flag(spark, table, incoming):
    odd = table.limit(1).withColumn("is_current", F.lit(None).cast("boolean")).withColumn("employee_id", F.lit("Z"))
    t = table.unionByName(odd)
    exp = scd2.scd2_expire(t, scd2.scd2_changes(t, incoming, "employee_id"), "employee_id", T1)
    assert exp.count() == t.count()
    assert scd2.scd2_apply(t, incoming, "employee_id", T1).filter("employee_id = 'Z'").count() == 1

"""Attendance and payroll silver rules on the FIXTURES.md edge rows."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strata.operators import quality
from strata.operators.dedupe import latest_by, split_duplicates

D = dt.date(2026, 5, 20)


def ts(h, m=0, s=0, day=20):
    return dt.datetime(2026, 5, day, h, m, s)


ATT_SCHEMA = ("attendance_id BIGINT, employee_id STRING, attendance_date DATE, attendance_status STRING, "
              "check_in_time TIMESTAMP_NTZ, check_out_time TIMESTAMP_NTZ, _ingest_ts TIMESTAMP_NTZ, _run_id STRING")
I1, I2 = dt.datetime(2026, 5, 20, 23), dt.datetime(2026, 5, 21, 23)


@pytest.fixture(scope="module")
def attendance(spark):
    rows = [
        (1, "E1", D, "Present", ts(9), ts(17, 30), I1, "r1"),
        (2, "E1", D, "Present", ts(9, 5), ts(17, 30), I1, "r1"),
        (3, "E2", D, "Absent", ts(9), None, I1, "r1"),
        (4, "E3", D, "Present", ts(6), ts(20), I1, "r1"),
        (5, "E4", D, "Present", ts(6), ts(20, 0, 1), I1, "r1"),
        (6, "E5", D, "Present", ts(22), ts(6), I1, "r1"),
        (7, None, None, "Leave", None, None, I1, "r1"),
        (8, None, None, "Leave", None, None, I1, "r1"),
        (10, "E7", D, "Present", ts(9), ts(17), I1, "r1"),
        (10, "E7", D, "Present", ts(9), ts(18), I2, "r2"),
        (9, "E6", D, "Present", ts(8), ts(16), I1, "r1"),
        (9, "E6", D, "Present", ts(8), ts(15), I1, "r1"),
    ]
    return spark.createDataFrame(rows, ATT_SCHEMA)


def silver_attendance(att):
    latest = latest_by(att, ["attendance_id"], [F.desc("_ingest_ts")])
    return quality.attendance_flags(quality.add_work_hours(latest))


def test_latest_ingest_wins_and_ties_are_deterministic(attendance):
    latest = silver_attendance(attendance)
    got = {r.attendance_id: r for r in latest.collect()}
    assert len(got) == 10
    assert got[10].check_out_time == ts(18)  # later ingest
    # id 9 twice in one ingest: the tiebreak (all columns ascending) picks the same row every run
    assert got[9].check_out_time == ts(15)
    assert silver_attendance(attendance).filter("attendance_id = 9").first().check_out_time == ts(15)


def test_work_hours_and_flags(attendance):
    rows = {r.attendance_id: r for r in silver_attendance(attendance).collect()}
    assert rows[1].work_hours == pytest.approx(8.5)
    assert rows[2].work_hours == pytest.approx(8 + 25 / 60)
    assert rows[3].work_hours is None
    assert rows[3].dq_status_with_times == "warn:absent_has_times"
    assert rows[4].work_hours == pytest.approx(14.0) and rows[4].dq_excess_hours is None  # strict >
    assert rows[5].dq_excess_hours == "warn:excess_hours"
    assert rows[6].work_hours == pytest.approx(-16.0) and rows[6].dq_excess_hours is None  # Q15 parity
    assert rows[7].dq_status_with_times is None  # Leave without times
    assert rows[10].work_hours == pytest.approx(9.0)


def test_strict_negative_hours(attendance):
    out = quality.attendance_flags(quality.add_work_hours(attendance), strict=True)
    assert out.filter("dq_negative_hours IS NOT NULL").select("attendance_id").collect()[0][0] == 6


def test_split_duplicates_parity(attendance):
    enriched = silver_attendance(attendance)
    clean, rej = split_duplicates(enriched, ["employee_id", "attendance_date"], [F.desc("attendance_id")],
                                  "duplicate_attendance")
    c = {r.attendance_id for r in clean.collect()}
    r = {x.attendance_id: x.rejection_reason for x in rej.collect()}
    assert r == {1: "duplicate_attendance", 7: "duplicate_attendance"}  # Q8: NULL keys form one group
    assert c == {2, 3, 4, 5, 6, 8, 9, 10}
    assert clean.count() + rej.count() == enriched.count()


def test_split_duplicates_strict_null_keys(attendance):
    enriched = silver_attendance(attendance)
    clean, rej = split_duplicates(enriched, ["employee_id", "attendance_date"], [F.desc("attendance_id")],
                                  "duplicate_attendance", null_key_reason="null_key")
    reasons = {x.attendance_id: x.rejection_reason for x in rej.collect()}
    assert reasons == {1: "duplicate_attendance", 7: "null_key", 8: "null_key"}
    assert {r.attendance_id for r in clean.collect()} == {2, 3, 4, 5, 6, 9, 10}


def test_split_duplicates_hot_key_and_exact_copies(spark):
    # one key holds a third of the rows, many of them exact copies of each other
    hot = spark.range(0, 3000).select(F.lit("HOT").alias("k"), (F.col("id") % 7).alias("v"))
    cold = spark.range(0, 6000).select(F.concat(F.lit("K"), (F.col("id") % 2000).cast("string")).alias("k"),
                                       F.col("id").alias("v"))
    df = hot.unionByName(cold)
    clean, rej = split_duplicates(df, ["k"], [F.desc("v")], "dup")
    assert clean.count() == 2001
    assert rej.count() == 9000 - 2001
    assert clean.filter("k = 'HOT'").first().v == 6
    # multiset preserved: clean + rejected == input
    back = clean.unionByName(rej.drop("rejection_reason"))
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0


def test_latest_by_plan_limits_before_shuffle(attendance):
    plan = latest_by(attendance, ["attendance_id"], [F.desc("_ingest_ts")])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


PAY_SCHEMA = ("payroll_id BIGINT, employee_id STRING, pay_period DATE, basic_salary STRING, bonus_amount STRING, "
              "deduction_amount STRING, net_pay STRING, processed_date STRING, _ingest_ts TIMESTAMP_NTZ, _run_id STRING")
P = dt.date(2026, 5, 1)


@pytest.fixture(scope="module")
def payroll(spark):
    rows = [
        (1, "E1", P, "1000.00", "100.00", "50.00", "1050.00", "2026-05-31", I1, "r1"),
        (2, "E1", P, "1000.00", "100.00", "50.00", "1050.01", "2026-06-02", I1, "r1"),
        (3, "E2", P, "1000.00", "0.00", "50.00", "950.02", "2026-05-30", I1, "r1"),
        (4, "E3", P, "1000.00", None, "50.00", "950.00", "2026-06-01", I1, "r1"),
        (5, "E4", dt.date(2026, 5, 15), "1000.00", "0.00", "0.00", "1000.00", "2026-06-01", I1, "r1"),
        (6, "E5", P, "10.00", "0.00", "0.00", "10.00", "2026-06-03", I1, "r1"),
        (7, "E5", P, "10.00", "0.00", "0.00", "10.00", "2026-06-03", I1, "r1"),
    ]
    return spark.createDataFrame(rows, PAY_SCHEMA)


def silver_payroll(pay):
    return quality.add_payroll_delay(quality.recompute_net_pay(pay))


def test_net_pay_and_delay(payroll):
    rows = {r.payroll_id: r for r in silver_payroll(payroll).collect()}
    assert rows[1].net_pay_corrected == Decimal("1050.00") and rows[1].net_pay_variance == Decimal("0.00")
    assert rows[1].payroll_delay_days == 0
    assert rows[2].net_pay_variance == Decimal("0.01") and rows[2].payroll_delay_days == 2
    assert rows[3].net_pay_variance == Decimal("0.02") and rows[3].payroll_delay_days == -1
    assert rows[3].dq_future_processing == "warn:processed_before_period_end"
    assert rows[4].net_pay_corrected is None and rows[4].net_pay_variance is None  # Q14
    assert silver_payroll(payroll).schema["net_pay_variance"].dataType.simpleString() == "decimal(19,2)"


def test_variance_profile(payroll):
    prof = quality.variance_profile(silver_payroll(payroll)).first()
    assert prof["count"] == 6 and prof["rows"] == 7
    assert prof["beyond_tolerance"] == 1  # only 0.02; 0.01 is not beyond (strict >)
    assert prof["flagged"] == 1
    assert prof["max"] == Decimal("0.02") and prof["min"] == Decimal("0.00")


def test_payroll_dedupe_latest_processed_then_highest_id(payroll):
    clean, rej = split_duplicates(silver_payroll(payroll), ["employee_id", "pay_period"],
                                  [F.desc("processed_date"), F.desc("payroll_id")], "duplicate_pay_period")
    assert {r.payroll_id for r in clean.collect()} == {2, 3, 4, 5, 7}
    assert {r.payroll_id for r in rej.collect()} == {1, 6}


def test_cast_or_reject(spark):
    raw = spark.createDataFrame([("1", "2026-05-01", "10.50"), ("x", "2026-05-02", "3"), ("3", "not a date", None),
                                 ("4", None, "99999999999999999999.99")], "id STRING, d STRING, amt STRING")
    typed, rej = quality.cast_or_reject(raw, {"id": "bigint", "d": "date", "amt": "decimal(18,2)"})
    assert [r.id for r in typed.collect()] == [1]
    assert typed.schema["d"].dataType.simpleString() == "date"
    bad = {r.bad_columns for r in rej.collect()}
    assert bad == {"id", "d", "amt"}
    assert typed.count() + rej.count() == raw.count()


def test_split_ties_resolve_by_content_on_every_run(spark):
    # same key, same order value, different content: the winner must not depend on staging order
    rows = [("k", 1, "b"), ("k", 1, "a"), ("k", 1, "c")]
    winners = set()
    for perm in ([0, 1, 2], [2, 1, 0], [1, 2, 0]):
        df = spark.createDataFrame([rows[i] for i in perm], "k STRING, v INT, w STRING").repartition(3)
        clean, _ = split_duplicates(df, ["k"], [F.desc("v")], "dup")
        winners.add(clean.first().w)
    assert len(winners) == 1  # by a hash of the row's content

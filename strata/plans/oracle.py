"""DuckDB SQL twins of the stand-ins and reports (independent oracle).

Each constant is a comma-separated list of CTEs; ``with_ctes`` assembles a
statement from the ones a query needs.  Definitions mirror
``strata.plans.standins`` literally (same parameters, same mappings).
"""

from __future__ import annotations

from strata.plans.standins import AS_OF, AS_OF_POINT, END_TIME, INGEST_TS, N_MONTHS, RUN_ID, START_TIME, T0, T1, T2

TS = lambda s: f"TIMESTAMP '{s}'"

ATT_B = f"""att_b AS (
  SELECT event_id AS attendance_id, user_id AS employee_id, CAST(ts AS DATE) AS attendance_date,
         CASE WHEN event_type = 'error' THEN 'Absent' WHEN event_type = 'signup' THEN 'Leave' ELSE 'Present' END
           AS attendance_status,
         CASE WHEN event_type <> 'signup' THEN ts END AS check_in_time,
         CASE WHEN event_type <> 'signup' THEN ts + to_seconds(CAST(floor(value * 240) AS BIGINT)) END
           AS check_out_time,
         {TS(INGEST_TS)} AS _ingest_ts, '{RUN_ID}' AS _run_id
  FROM events)"""

ATT_E = """att_e AS (
  SELECT *, CASE WHEN attendance_status IN ('Absent', 'Leave') AND check_in_time IS NOT NULL
                 THEN 'warn:absent_has_times' END AS dq_status_with_times,
            CASE WHEN work_hours > 14 THEN 'warn:excess_hours' END AS dq_excess_hours
  FROM (SELECT *, check_in_time AS check_in_ts, check_out_time AS check_out_ts,
               (floor(epoch(check_out_time)) - floor(epoch(check_in_time))) / 3600.0 AS work_hours
        FROM att_b)),
att_r AS (
  SELECT *, row_number() OVER (PARTITION BY employee_id, attendance_date ORDER BY attendance_id DESC) AS _rn
  FROM att_e)"""

PAY_B = f"""li AS (
  SELECT l_orderkey,
         SUM(CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT)) AS basic,
         SUM(CAST(floor(l_tax * 100 * 100 + 0.5) AS BIGINT)) AS bonus,
         SUM(CAST(floor(l_discount * 100 * 100 + 0.5) AS BIGINT)) AS deduction,
         MAX(l_shipdate) AS shipped
  FROM lineitem GROUP BY l_orderkey),
pay_b AS (
  SELECT o_orderkey AS payroll_id, o_custkey AS employee_id,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS pay_period,
         CAST(CAST(li.basic AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2)) AS basic_salary,
         CAST(CAST(li.bonus AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2)) AS bonus_amount,
         CAST(CAST(li.deduction AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2)) AS deduction_amount,
         o_totalprice AS net_pay, CAST(li.shipped AS DATE) AS processed_date,
         {TS(INGEST_TS)} AS _ingest_ts, '{RUN_ID}' AS _run_id
  FROM orders LEFT JOIN li ON li.l_orderkey = orders.o_orderkey)"""

PAY_E = """pay_c AS (
  SELECT *, CAST(net_pay AS DECIMAL(18,2)) AS net_pay_raw,
         CAST(basic_salary + bonus_amount - deduction_amount AS DECIMAL(18,2)) AS net_pay_corrected
  FROM pay_b),
pay_e AS (
  SELECT *, CAST(net_pay_raw - net_pay_corrected AS DECIMAL(19,2)) AS net_pay_variance,
         last_day(pay_period) AS pay_period_end,
         CAST(date_diff('day', last_day(pay_period), processed_date) AS INTEGER) AS payroll_delay_days,
         CASE WHEN date_diff('day', last_day(pay_period), processed_date) < 0
              THEN 'warn:processed_before_period_end' END AS dq_future_processing
  FROM pay_c),
pay_r AS (
  SELECT *, row_number() OVER (PARTITION BY employee_id, pay_period
                               ORDER BY processed_date DESC NULLS LAST, payroll_id DESC) AS _rn
  FROM pay_e)"""

ATT_L = """att_l AS (
  SELECT o.o_custkey AS employee_id, CAST(l.l_shipdate AS DATE) AS attendance_date,
         CASE l.l_returnflag WHEN 'A' THEN 'Present' WHEN 'R' THEN 'Absent' ELSE 'Leave' END AS attendance_status
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
cnt AS (
  SELECT employee_id, CAST(date_trunc('month', attendance_date) AS DATE) AS pay_period,
         CAST(SUM(CASE WHEN attendance_status = 'Present' THEN 1 ELSE 0 END) AS BIGINT) AS days_present,
         CAST(SUM(CASE WHEN attendance_status = 'Absent' THEN 1 ELSE 0 END) AS BIGINT) AS days_absent
  FROM att_l GROUP BY 1, 2)"""


def snapshot_cte(name: str, as_of: str) -> str:
    return f"""{name} AS (
  SELECT c.c_custkey AS employee_id, c.c_nationkey AS department_id,
         CASE WHEN o.o_orderpriority <> '4-NOT SPECIFIED' THEN o.o_orderpriority END AS designation,
         CAST(o.o_totalprice AS DECIMAL(18,2)) AS salary,
         CASE o.o_orderstatus WHEN 'O' THEN 'Active' WHEN 'F' THEN 'Resigned' WHEN 'P' THEN 'Notice' END
           AS employment_status,
         c.c_name AS employee_name
  FROM (SELECT * FROM orders WHERE o_orderdate < {TS(as_of)}
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1) o
  JOIN customer c ON c.c_custkey = o.o_custkey)"""


TRACKED_SQL = ("department_id", "designation", "salary", "employment_status")


def change_sql(null_safe: bool) -> str:
    if null_safe:
        return " OR ".join(f"cur.{c} IS DISTINCT FROM inc.{c}" for c in TRACKED_SQL)
    return " OR ".join(f"cur.{c} <> inc.{c}" for c in TRACKED_SQL)


def emp_ctes(null_safe: bool = False, v1: str = "v1") -> str:
    cols = "employee_id, department_id, designation, salary, employment_status, employee_name, effective_from"
    return f"""{snapshot_cte('snap0', T0)},
{snapshot_cte('snap1', T1)},
v0 AS (SELECT *, {TS(T0)} AS effective_from, CAST(NULL AS TIMESTAMP) AS effective_to, true AS is_current FROM snap0),
cur AS (SELECT * FROM v0 WHERE is_current),
hist AS (SELECT * FROM v0 WHERE NOT is_current),
inc AS (SELECT *, {TS(T1)} AS effective_from, CAST(NULL AS TIMESTAMP) AS effective_to, true AS is_current FROM snap1),
ch AS (SELECT cur.employee_id FROM cur JOIN inc ON cur.employee_id = inc.employee_id WHERE {change_sql(null_safe)}),
expired AS (
  SELECT * FROM hist
  UNION ALL
  SELECT {cols},
         CASE WHEN employee_id IN (SELECT employee_id FROM ch) THEN {TS(T1)} ELSE effective_to END AS effective_to,
         CASE WHEN employee_id IN (SELECT employee_id FROM ch) THEN false ELSE is_current END AS is_current
  FROM cur),
newk AS (SELECT * FROM snap1 s WHERE NOT EXISTS (SELECT 1 FROM cur WHERE cur.employee_id = s.employee_id)),
{v1} AS (
  SELECT * FROM expired
  UNION ALL SELECT * FROM inc WHERE NOT EXISTS (SELECT 1 FROM cur WHERE cur.employee_id = inc.employee_id)
  UNION ALL SELECT * FROM inc WHERE employee_id IN (SELECT employee_id FROM ch))"""


# round(avg(decimal(18,2)), 2) as Spark computes it: exact decimal average
# rounded HALF_UP to 6 places (the avg result scale), then HALF_UP to 2.
# DuckDB's AVG(DECIMAL) goes through a double, which can land a tie like
# .915 on .91, so the average is done here in integer cents.


def decimal_avg(x: str, digits: int, scale: int = 2) -> str:
    """round(avg(x), digits) for a decimal(_, scale) column, in exact integers, as a DOUBLE."""
    unit = 10 ** (6 - scale)   # source units -> 1e-6 units
    step = 10 ** (6 - digits)  # 1e-6 units per output unit
    total = f"CAST(abs(SUM({x})) * {10 ** scale} AS HUGEINT)"
    avg6 = f"((2 * {total} * {unit} + COUNT({x})) // (2 * COUNT({x})))"
    rounded = f"((2 * {avg6} + {step}) // {2 * step})"
    return (f"CASE WHEN COUNT({x}) = 0 THEN NULL "
            f"ELSE CAST(sign(SUM({x})) * {rounded} AS DOUBLE) / {float(10 ** digits)} END")


DEPT = "dept AS (SELECT n_nationkey AS department_id, n_name AS department_name FROM nation)"

SPINE = f"""spine AS (
  SELECT strftime(last_day(DATE '{AS_OF[:10]}' - to_months(CAST(i AS INTEGER))), '%Y-%m') AS snapshot_month,
         CAST(year(DATE '{AS_OF[:10]}') * 12 + month(DATE '{AS_OF[:10]}') - 1 - i AS INTEGER) AS month_idx
  FROM range(0, {N_MONTHS}) t(i))"""

WORKFORCE = f"""ws AS (
  SELECT e.department_id, d.department_name, COUNT(*) AS headcount,
         CAST(SUM(CASE WHEN e.employment_status = 'Active' THEN 1 ELSE 0 END) AS BIGINT) AS active_count,
         {decimal_avg("e.salary", 2)} AS avg_salary,
         CAST(SUM(CASE WHEN e.employment_status IN ('Resigned', 'Notice') THEN 1 ELSE 0 END) AS BIGINT)
           AS attrition_count,
         {TS(AS_OF)} AS refresh_ts
  FROM v1 e LEFT JOIN dept d ON e.department_id = d.department_id
  WHERE e.is_current
  GROUP BY e.department_id, d.department_name)"""

HEADCOUNT = """hc AS (
  SELECT e.department_id, m.snapshot_month, COUNT(*) AS headcount
  FROM v1 e JOIN spine m
    ON e.effective_from <= CAST(last_day(CAST(m.snapshot_month || '-01' AS DATE)) AS TIMESTAMP)
   AND (e.effective_to IS NULL OR e.effective_to > CAST(last_day(CAST(m.snapshot_month || '-01' AS DATE)) AS TIMESTAMP))
  WHERE e.employment_status = 'Active'
  GROUP BY 1, 2)"""

PAY_CLEAN_COLS = ("payroll_id, employee_id, pay_period, basic_salary, bonus_amount, deduction_amount, net_pay, "
                  "processed_date, _ingest_ts, _run_id, net_pay_raw, net_pay_corrected, net_pay_variance, "
                  "pay_period_end, payroll_delay_days, dq_future_processing")
ATT_CLEAN_COLS = ("attendance_id, employee_id, attendance_date, attendance_status, check_in_time, check_out_time, "
                  "_ingest_ts, _run_id, check_in_ts, check_out_ts, work_hours, dq_status_with_times, dq_excess_hours")


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


EARLY = f"(o_orderdate < {TS(T0)})"


def bronze_latest(*runs: tuple[str, str, str, int]) -> str:
    """Latest row per order over runs of (run id, ingest time, which rows, added to the price)."""
    parts = " UNION ALL ".join(
        f"SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + {plus}.0 AS o_totalprice, o_orderdate, o_orderpriority, "
        f"{TS(ts)} AS _ingest_ts, '{run}' AS _run_id FROM orders WHERE {which}" for run, ts, which, plus in runs)
    return f"SELECT * FROM ({parts}) QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY _ingest_ts DESC) = 1"


def tracked_snapshot(name: str, as_of: str) -> str:
    return f"""{name} AS (
  SELECT CASE WHEN c_mktsegment = 'BUILDING' AND c_acctbal < 0 THEN NULL ELSE c_custkey END AS employee_id,
         c_nationkey AS department_id, 'Staff' AS designation,
         CASE WHEN o_totalprice >= 100000 THEN c_nationkey END AS manager_id,
         CAST(floor(c_acctbal / 1000) AS DECIMAL(18,2)) AS salary,
         CASE WHEN o_orderstatus = 'P' THEN 'Notice' ELSE 'Active' END AS employment_status, c_name AS employee_name
  FROM (SELECT * FROM orders WHERE o_orderdate < {TS(as_of)}
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1) o
  JOIN customer ON c_custkey = o_custkey)"""


def tracked_history(null_safe: bool) -> str:
    """Three runs: the first opens every row; each later one closes changed rows and opens changed, new and NULL-key rows."""
    cols = ("department_id", "designation", "manager_id", "salary", "employment_status")
    differs = " OR ".join(f"t.{c} IS DISTINCT FROM s.{c}" if null_safe else f"t.{c} <> s.{c}" for c in cols)
    names = "employee_id, department_id, designation, manager_id, salary, employment_status, employee_name"

    def step(prev: str, snap: str, at: str, out: str) -> str:
        return f"""{out}_ch AS (SELECT t.employee_id FROM {prev} t JOIN {snap} s ON t.employee_id = s.employee_id
                   WHERE t.is_current AND ({differs})),
{out} AS (
  SELECT {names}, effective_from,
         CASE WHEN is_current AND employee_id IN (SELECT * FROM {out}_ch) THEN {TS(at)} ELSE effective_to END AS effective_to,
         is_current AND (employee_id IS NULL OR employee_id NOT IN (SELECT * FROM {out}_ch)) AS is_current FROM {prev}
  UNION ALL
  SELECT {names}, {TS(at)}, CAST(NULL AS TIMESTAMP), true FROM {snap} s
  WHERE s.employee_id IS NULL OR s.employee_id IN (SELECT * FROM {out}_ch)
     OR NOT EXISTS (SELECT 1 FROM {prev} t WHERE t.is_current AND t.employee_id = s.employee_id))"""

    return with_ctes(
        tracked_snapshot("s0", T0), tracked_snapshot("s1", T1), tracked_snapshot("s2", T2),
        f"e0 AS (SELECT *, {TS(T0)} AS effective_from, CAST(NULL AS TIMESTAMP) AS effective_to, true AS is_current FROM s0)",
        step("e0", "s1", T1, "e1"), step("e1", "s2", T2, "e2"), body="SELECT * FROM e2")


ORACLE: dict[str, str] = {
    "dedupe_clean": with_ctes(ATT_B, ATT_E, body=f"SELECT {ATT_CLEAN_COLS} FROM att_r WHERE _rn = 1"),
    "dedupe_rejected": with_ctes(
        ATT_B, ATT_E,
        body="SELECT attendance_id, employee_id, attendance_date, attendance_status, "
             "'duplicate_attendance' AS rejection_reason, _ingest_ts, _run_id FROM att_r WHERE _rn > 1"),
    "work_hours": with_ctes(ATT_B, ATT_E, body="SELECT attendance_id, check_in_ts, check_out_ts, work_hours FROM att_e"),
    "dq_flags": with_ctes(
        ATT_B, ATT_E,
        body="SELECT attendance_id, attendance_status, work_hours, dq_status_with_times, dq_excess_hours FROM att_e"),
    "row_metrics": with_ctes(
        ATT_B, ATT_E,
        body="SELECT COUNT(*) AS rows_in, CAST(SUM(CASE WHEN _rn = 1 THEN 1 ELSE 0 END) AS BIGINT) AS clean, "
             "CAST(SUM(CASE WHEN _rn > 1 THEN 1 ELSE 0 END) AS BIGINT) AS rejected, "
             "CAST(SUM(CASE WHEN _rn = 1 AND (dq_status_with_times IS NOT NULL OR dq_excess_hours IS NOT NULL) "
             "THEN 1 ELSE 0 END) AS BIGINT) AS flagged FROM att_r"),
    "preview_attendance": with_ctes(
        ATT_B, ATT_E,
        body="SELECT attendance_id, employee_id, attendance_date, attendance_status, work_hours FROM att_r "
             "WHERE _rn = 1 ORDER BY employee_id, attendance_date LIMIT 20"),
    "net_pay_corrected": with_ctes(
        PAY_B, PAY_E, body="SELECT payroll_id, net_pay_raw, net_pay_corrected, net_pay_variance FROM pay_e"),
    "payroll_delay": with_ctes(
        PAY_B, PAY_E,
        body="SELECT payroll_id, pay_period, processed_date, pay_period_end, payroll_delay_days FROM pay_e"),
    "dq_future_processing": with_ctes(
        PAY_B, PAY_E, body="SELECT payroll_id, payroll_delay_days, dq_future_processing FROM pay_e"),
    "variance_profile": with_ctes(
        PAY_B, PAY_E,
        body=f"SELECT COUNT(net_pay_variance) AS count, {decimal_avg('net_pay_variance', 4)} AS mean, "
             "CAST(ROUND(STDDEV_SAMP(net_pay_variance), 4) AS DOUBLE) AS stddev, "
             "MIN(net_pay_variance) AS min, MAX(net_pay_variance) AS max, "
             "CAST(SUM(CASE WHEN ABS(net_pay_variance) > 0.01 THEN 1 ELSE 0 END) AS BIGINT) AS beyond_tolerance, "
             "CAST(SUM(CASE WHEN dq_future_processing IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS flagged, "
             "COUNT(*) AS rows FROM pay_e"),
    "payroll_clean": with_ctes(PAY_B, PAY_E, body=f"SELECT {PAY_CLEAN_COLS} FROM pay_r WHERE _rn = 1"),
    "payroll_rejected": with_ctes(
        PAY_B, PAY_E,
        body="SELECT payroll_id, employee_id, pay_period, 'duplicate_pay_period' AS rejection_reason, "
             "net_pay_raw, net_pay_corrected, _ingest_ts, _run_id FROM pay_r WHERE _rn > 1"),
    "monthly_status_counts": with_ctes(ATT_L, body="SELECT * FROM cnt"),
    "attendance_payroll": with_ctes(
        PAY_B, PAY_E, ATT_L,
        body=f"SELECT p.employee_id, p.pay_period, COALESCE(c.days_present, 0) AS days_present, "
             f"COALESCE(c.days_absent, 0) AS days_absent, p.net_pay_corrected, p.payroll_delay_days, "
             f"{TS(AS_OF)} AS refresh_ts "
             f"FROM (SELECT * FROM pay_r WHERE _rn = 1) p LEFT JOIN cnt c "
             f"ON p.employee_id = c.employee_id AND p.pay_period = c.pay_period"),
    "latest_by": "SELECT * FROM orders QUALIFY row_number() OVER "
                 "(PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1",
    "scd2_init": with_ctes(emp_ctes(), body="SELECT * FROM v0"),
    "scd2_changes": with_ctes(emp_ctes(), body="SELECT employee_id FROM ch"),
    "scd2_new_keys": with_ctes(emp_ctes(), body="SELECT * FROM newk"),
    "scd2_expire": with_ctes(emp_ctes(), body="SELECT * FROM expired"),
    "scd2_apply": with_ctes(emp_ctes(), body="SELECT * FROM v1"),
    "scd2_apply_null_safe": with_ctes(emp_ctes(null_safe=True), body="SELECT * FROM v1"),
    "scd2_as_of": with_ctes(
        emp_ctes(),
        body=f"SELECT * FROM v1 WHERE effective_from <= {TS(AS_OF_POINT)} "
             f"AND (effective_to IS NULL OR effective_to > {TS(AS_OF_POINT)})"),
    "month_spine": "WITH m AS (SELECT CAST(max(o_orderdate) AS DATE) AS d FROM orders) "
                   "SELECT strftime(last_day(d - to_months(CAST(i AS INTEGER))), '%Y-%m') AS snapshot_month, "
                   "CAST(year(d) * 12 + month(d) - 1 - i AS INTEGER) AS month_idx "
                   f"FROM m, range(0, {N_MONTHS}) t(i) WHERE d IS NOT NULL",
    "headcount_history": with_ctes(emp_ctes(), SPINE, HEADCOUNT, body="SELECT * FROM hc"),
    "headcount_history_expanded": with_ctes(emp_ctes(), SPINE, HEADCOUNT, body="SELECT * FROM hc"),
    "headcount_history_sweep": with_ctes(emp_ctes(), SPINE, HEADCOUNT, body="SELECT * FROM hc"),
    "sorted_history": with_ctes(emp_ctes(), SPINE, HEADCOUNT, body="SELECT * FROM hc ORDER BY snapshot_month, department_id"),
    "workforce_summary": with_ctes(emp_ctes(), DEPT, WORKFORCE, body="SELECT * FROM ws"),
    "top_attrition": with_ctes(
        emp_ctes(), DEPT, WORKFORCE,
        body="SELECT * FROM ws ORDER BY attrition_count DESC, department_id LIMIT 5"),
    "status_breakdown": with_ctes(
        emp_ctes(), body="SELECT employment_status, COUNT(*) AS cnt FROM v1 WHERE is_current GROUP BY 1"),
    "status_breakdown_sql": with_ctes(
        emp_ctes(), body="SELECT employment_status, COUNT(*) AS cnt FROM v1 WHERE is_current GROUP BY 1"),
    "compare_versions": with_ctes(
        emp_ctes(),
        body="SELECT 'now' AS snapshot, COUNT(*) AS active_count FROM v1 "
             "WHERE is_current AND employment_status = 'Active' "
             "UNION ALL SELECT 'v0', COUNT(*) FROM v0 WHERE is_current AND employment_status = 'Active'"),
    "version_history": with_ctes(
        emp_ctes(),
        body="SELECT 0 AS version, (SELECT COUNT(*) FROM v0) AS num_rows UNION ALL SELECT 1, (SELECT COUNT(*) FROM v1)"),
    "read_version": with_ctes(emp_ctes(), body="SELECT *, 0 AS version FROM v0"),
    "compact_and_cluster": "SELECT * FROM orders",
    "cluster_ranges": "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS overlaps, least(ceil(count(*) * 40 / 65536.0), 2)::BIGINT AS files_up_to_two FROM orders",
    "csv_roundtrip": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, "
                     "CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority FROM orders",
    "bronze_append": f"SELECT event_id, ts, user_id, event_type, value, props, {TS(INGEST_TS)} AS _ingest_ts, "
                     "'events/2024-02-01' AS landed, r AS _run_id FROM events, (VALUES ('001'), ('r2')) t(r)",
    "csv_inferred": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, "
                    "o_orderpriority FROM orders",
    "latest_incremental": bronze_latest(("r1", T0, EARLY, 0), ("r2", T1, "true", 100)),
    "latest_skipped_run": bronze_latest(("r1", T0, EARLY, 0), ("r2", T1, f"NOT {EARLY}", 50), ("r3", T2, EARLY, 100)),
    "latest_rerun": bronze_latest(("r1", T0, EARLY, 25), ("r2", T1, f"NOT {EARLY}", 50)),
    "latest_late_run": bronze_latest(("r2", T1, f"NOT {EARLY}", 50), ("r1", T0, "true", 0)),
    "typed_values": "SELECT event_id, TRY_CAST(CAST(value AS VARCHAR) AS DECIMAL(4,2)) AS value FROM events "
                    "WHERE TRY_CAST(CAST(value AS VARCHAR) AS DECIMAL(4,2)) IS NOT NULL OR value IS NULL",
    "bad_values": "SELECT event_id, CAST(value AS VARCHAR) AS value, 'value' AS bad_columns, "
                  "'bad_value' AS rejection_reason FROM events "
                  "WHERE value IS NOT NULL AND TRY_CAST(CAST(value AS VARCHAR) AS DECIMAL(4,2)) IS NULL",
    "schema_evolution": "SELECT c_custkey, c_name, c_nationkey, c_acctbal, CAST(NULL AS VARCHAR) AS c_mktsegment, "
                        "'r1' AS _run_id FROM customer "
                        "UNION ALL SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 'r2' FROM customer",
    "stream_ingest": "SELECT event_id, ts, user_id, event_type, value, props, 'events/' || day AS landed, r AS _run_id "
                     "FROM events, (VALUES ('r1', '2024-02-01'), ('r2', '2024-02-02')) t(r, day)",
    "silver_reingested": with_ctes(ATT_B, body=f"""
      , runs AS (SELECT * REPLACE ('r1' AS _run_id, {TS(T0)} AS _ingest_ts) FROM att_b
        UNION ALL SELECT * REPLACE ('r2' AS _run_id, {TS(T1)} AS _ingest_ts, 'Absent' AS attendance_status) FROM att_b
                  WHERE attendance_status <> 'Absent'
        UNION ALL SELECT * REPLACE ('r3' AS _run_id, {TS(T2)} AS _ingest_ts) FROM att_b WHERE attendance_status = 'Leave'),
      last AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY attendance_id ORDER BY _ingest_ts DESC) = 1)
      SELECT attendance_id, employee_id, attendance_date, attendance_status, _run_id,
             (floor(epoch(check_out_time)) - floor(epoch(check_in_time))) / 3600.0 AS work_hours,
             CASE WHEN attendance_status IN ('Absent', 'Leave') AND check_in_time IS NOT NULL
                  THEN 'warn:absent_has_times' END AS dq_status_with_times
      FROM last QUALIFY row_number() OVER (PARTITION BY employee_id, attendance_date ORDER BY attendance_id DESC) = 1"""),
    "rejected_append": with_ctes(
        ATT_B, ATT_E,
        body="SELECT attendance_id, employee_id, attendance_date, attendance_status, 'duplicate_attendance' AS "
             "rejection_reason, _ingest_ts, _run_id AS _ingest_run_id, r AS _run_id FROM att_r, (VALUES ('r1'), ('r2')) t(r) "
             "WHERE _rn > 1"),
    "table_overwrite": "SELECT c_custkey, c_name FROM customer",
    "attendance_payroll_text_month": with_ctes(
        PAY_B, PAY_E, ATT_L,
        body=f"SELECT p.employee_id, p.pay_period, COALESCE(c.days_present, 0) AS days_present, "
             f"COALESCE(c.days_absent, 0) AS days_absent, p.net_pay_corrected, p.payroll_delay_days, "
             f"{TS(AS_OF)} AS refresh_ts "
             f"FROM (SELECT * FROM pay_r WHERE _rn = 1) p LEFT JOIN cnt c "
             f"ON p.employee_id = c.employee_id AND p.pay_period = c.pay_period"),
    "headcount_zero_filled": with_ctes(
        emp_ctes(), SPINE, HEADCOUNT,
        body="SELECT d.department_id, m.snapshot_month, CAST(COALESCE(hc.headcount, 0) AS BIGINT) AS headcount "
             "FROM (SELECT DISTINCT department_id FROM hc) d CROSS JOIN spine m LEFT JOIN hc "
             "ON hc.department_id = d.department_id AND hc.snapshot_month = m.snapshot_month"),
    "latest_ranked": bronze_latest(("r2", T0, "true", 0), ("r3", T1, EARLY, 50)),
    "empty_rerun": "SELECT *, 'r1' AS _run_id FROM orders",
    "runs_summary": f"SELECT '001' AS _run_id, count(*) FILTER (WHERE {EARLY}) AS rows FROM orders UNION ALL SELECT '002', 0 "
                    "UNION ALL SELECT '003', count(*) FROM orders",
    "footer_counts": "SELECT l_returnflag, count(*) AS rows, min(l_orderkey) AS min_l_orderkey, max(l_orderkey) AS max_l_orderkey "
                     "FROM lineitem GROUP BY l_returnflag",
    "scd2_corrected_rerun": tracked_history(False),
    "scd2_history": tracked_history(False),
    "scd2_history_null_safe": tracked_history(True),
    "audit_row": with_ctes(
        ATT_B, ATT_E, PAY_B, PAY_E, emp_ctes(),
        body=f"SELECT 'r1' AS run_id, 'pl_master_hr' AS pipeline_name, 'all_sources' AS source_name, "
             f"'Full' AS load_type, {TS(START_TIME)} AS start_time, {TS(END_TIME)} AS end_time, "
             f"CAST(n_read AS BIGINT) AS records_read, CAST(n_read AS BIGINT) AS records_inserted, "
             f"CAST(0 AS BIGINT) AS records_updated, CAST(n_rej AS BIGINT) AS records_rejected, 'Success' AS status, "
             f"CAST(NULL AS VARCHAR) AS error_message FROM ("
             f"SELECT (SELECT COUNT(*) FROM att_r WHERE _rn = 1) + (SELECT COUNT(*) FROM pay_r WHERE _rn = 1) "
             f"+ (SELECT COUNT(*) FROM v1) AS n_read, "
             f"(SELECT COUNT(*) FROM att_r WHERE _rn > 1) + (SELECT COUNT(*) FROM pay_r WHERE _rn > 1) AS n_rej)"),
}

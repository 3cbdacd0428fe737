"""Gold reports: workforce summary, headcount history, attendance x payroll.

Every report takes ``as_of`` for its refresh stamp and month spine; nothing
reads the clock.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.functions.columns import (
    month_end_midnight,
    month_index,
    month_label,
    month_label_from_index,
    month_start,
    typed_timestamp,
)
from strata.operators.scd2 import CURRENT, FROM, TO

# Fixed values that must equal the reference's for the same results.
ACTIVE_STATUS = "Active"
ATTRITION_STATUSES = ("Resigned", "Notice")
PRESENT_STATUS = "Present"
ABSENT_STATUS = "Absent"


def workforce_summary(
    employees: DataFrame,
    departments: DataFrame,
    as_of,
    active: str = ACTIVE_STATUS,
    attrition: Sequence[str] = ATTRITION_STATUSES,
    current_only: bool = True,
    ts_type: str = "timestamp_ntz",
) -> DataFrame:
    """Per department: headcount, active, average salary (2 dp), attrition.

    Employees are aggregated per ``department_id`` first (partial + final
    aggregate), so only one row per department meets the department table;
    unknown departments keep a NULL name, departments without employees do
    not appear.  AQE broadcasts the department side if its measured size is
    small.  Requires one department row per ``department_id``
    (the silver department table is ``latest_by`` department).
    """
    emp = employees.filter(F.col(CURRENT)) if current_only and CURRENT in employees.columns else employees
    status = F.col("employment_status")
    per_dept = emp.groupBy("department_id").agg(
        F.count(F.lit(1)).alias("headcount"),
        F.sum(F.when(status == active, 1).otherwise(0)).cast("bigint").alias("active_count"),
        F.round(F.avg("salary"), 2).alias("avg_salary"),
        F.sum(F.when(status.isin(list(attrition)), 1).otherwise(0)).cast("bigint").alias("attrition_count"),
    )
    return per_dept.join(departments.select("department_id", "department_name"), "department_id", "left").select(
        "department_id", "department_name", "headcount", "active_count", "avg_salary", "attrition_count",
        typed_timestamp(as_of, ts_type).alias("refresh_ts"),
    )


def month_spine(spark: SparkSession, as_of, n_months: int = 12) -> DataFrame:
    """The ``n_months`` calendar months ending with the month of ``as_of``.

    Columns: ``snapshot_month`` (``yyyy-MM``), ``month_idx``.  Its size is the
    parameter ``n_months``, a proven bound for broadcasting.
    """
    d = as_of.date() if isinstance(as_of, _dt.datetime) else as_of
    base = F.to_date(F.lit(str(d)[:10]))
    return spark.range(0, n_months).select(
        month_label(F.last_day(F.add_months(base, -F.col("id").cast("int")))).alias("snapshot_month"),
        (month_index(base) - F.col("id")).cast("int").alias("month_idx"),
    )


def month_spine_from(df: DataFrame, ts_col: str, n_months: int = 12) -> DataFrame:
    """The ``n_months`` months ending with the month of the latest ``ts_col`` in ``df``.

    One aggregate pass over ``df`` (partial + final), then the single result
    row is expanded to ``n_months`` rows; no join.
    """
    latest = df.agg(F.max(F.to_date(ts_col)).alias("_d"))
    ids = latest.select("_d", F.explode(F.sequence(F.lit(0), F.lit(n_months - 1))).alias("id"))
    return ids.filter(F.col("_d").isNotNull()).select(
        month_label(F.last_day(F.add_months(F.col("_d"), -F.col("id").cast("int")))).alias("snapshot_month"),
        (month_index(F.col("_d")) - F.col("id")).cast("int").alias("month_idx"),
    )


def _active(versions: DataFrame, active: str | None) -> DataFrame:
    return versions if active is None else versions.filter(F.col("employment_status") == active)


def headcount_history(
    versions: DataFrame,
    spark: SparkSession,
    as_of,
    n_months: int = 12,
    active: str | None = ACTIVE_STATUS,
    plan: str = "expand",
    end_of_day: bool = False,
    ts_type: str = "timestamp_ntz",
    zero_fill: bool = False,
) -> DataFrame:
    """Versions active at each month end, counted per (department, month).

    A version counts for month m when ``from <= M`` and ``to`` is NULL or
    ``to > M``, with M = midnight of the month's last day (parity; a version
    starting at 09:00 on the 31st is not counted).  ``end_of_day`` moves M to
    the last microsecond of that day instead.  Months without versions give
    no row; with ``zero_fill`` every department that has a version in the
    spine gets a row for every month of it, 0 where it has none.

    plan="expand" (default): each version lists the spine months it covers
    (``sequence`` + ``explode``, at most ``n_months`` per version), then one
    hash aggregate.  Linear in versions; no join.
    plan="range_join": the reference's shape (versions x months under the
    interval predicate) as a binned equi-join: each version lists its
    candidate months ``month(from)`` .. ``month(to)`` clipped to the spine,
    joins the broadcast spine (``n_months`` rows, a proven bound) on the
    month index, and the exact interval predicate is applied to each pair.
    No nested loop; the boundary rule is evaluated independently of the
    arithmetic of the expand plan.
    plan="sweep": two events per version (+1 at its first month, -1 after
    its last), summed per (department, month), then a running sum over the
    months where a department's count changes; each holds until the next
    one (``lead``) and lists its months.  Constant work per version whatever
    ``n_months`` is; a hot department is at most ``n_months`` + 1 rows after
    the partial aggregation.
    """
    if plan not in ("expand", "range_join", "sweep"):
        raise ValueError("plan must be 'expand', 'range_join' or 'sweep'")
    if zero_fill:
        found = headcount_history(versions, spark, as_of, n_months, active, plan, end_of_day, ts_type)
        return _zero_filled(found, as_of, n_months)
    spine = month_spine(spark, as_of, n_months)
    v = _active(versions, active).select("department_id", FROM, TO)
    lo = F.lit(month_index_of(as_of) - n_months + 1)
    hi = F.lit(month_index_of(as_of))
    frm, to = F.col(FROM), F.col(TO)

    if plan == "range_join":
        first_c = F.greatest(month_index(frm), lo)
        last_c = F.least(F.coalesce(month_index(to), hi), hi)
        bins = v.select("department_id", FROM, TO, first_c.alias("_f"), last_c.alias("_l")).filter(
            F.col("_f") <= F.col("_l")
        ).select("department_id", FROM, TO, F.explode(F.sequence("_f", "_l")).alias("month_idx"))
        pairs = bins.join(F.broadcast(spine), "month_idx", "inner")
        m_end = month_end_midnight(F.col("snapshot_month")).cast(ts_type)
        if end_of_day:
            m_end = m_end + F.expr("INTERVAL '0 23:59:59.999999' DAY TO SECOND")
        inside = (frm <= m_end) & (to.isNull() | (to > m_end))
        return pairs.filter(inside).groupBy("department_id", "snapshot_month").agg(
            F.count(F.lit(1)).alias("headcount")
        )

    def month_end_of(ts: Column) -> Column:
        end = F.last_day(F.to_date(ts)).cast(ts_type)
        if end_of_day:
            end = end + F.expr("INTERVAL '0 23:59:59.999999' DAY TO SECOND")
        return end

    # first month whose end is at or after `from`; last month whose end is before `to`
    first = month_index(frm) + F.when(frm > month_end_of(frm), 1).otherwise(0)
    last = F.when(to.isNull(), hi).otherwise(month_index(to) - F.when(to > month_end_of(to), 0).otherwise(1))
    first_c, last_c = F.greatest(first, lo), F.least(last, hi)
    covered = v.select("department_id", first_c.alias("_f"), last_c.alias("_l")).filter(
        F.col("_f") <= F.col("_l")
    )
    if plan == "sweep":
        # two events per version: +1 at its first month, -1 after its last;
        # summed per (department, month) with map-side partial aggregation
        ev = covered.select(
            "department_id",
            F.inline(F.array(
                F.struct(F.col("_f").alias("month_idx"), F.lit(1).alias("d")),
                F.struct((F.col("_l") + 1).alias("month_idx"), F.lit(-1).alias("d")),
            )),
        )
        deltas = ev.groupBy("department_id", "month_idx").agg(F.sum("d").alias("delta"))
        by_month = Window.partitionBy("department_id").orderBy("month_idx")
        steps = deltas.select(
            "department_id", "month_idx",
            F.sum("delta").over(by_month.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("bigint").alias("headcount"),
            F.lead("month_idx", 1).over(by_month).alias("_next"),
        ).filter(F.col("headcount") > 0)
        # a positive count always ends: every +1 has its -1 by the month after the spine
        return steps.select(
            "department_id", "headcount", F.explode(F.sequence("month_idx", F.col("_next") - 1)).alias("month_idx"),
        ).select("department_id", month_label_from_index("month_idx").alias("snapshot_month"), "headcount")

    months = covered.select("department_id", F.explode(F.sequence("_f", "_l")).alias("month_idx"))
    return months.groupBy("department_id", "month_idx").agg(F.count(F.lit(1)).alias("headcount")).select(
        "department_id", month_label_from_index("month_idx").alias("snapshot_month"), "headcount"
    )


def _zero_filled(found: DataFrame, as_of, n_months: int) -> DataFrame:
    """Every month of the spine for each department of ``found``: its counts per month are gathered in one
    map of at most ``n_months`` entries, then listed with 0 where there is none."""
    by_dept = found.groupBy("department_id").agg(
        F.map_from_entries(F.collect_list(F.struct("snapshot_month", "headcount"))).alias("_h"))
    hi = month_index_of(as_of)
    months = by_dept.select("department_id", "_h", F.explode(F.sequence(F.lit(hi - n_months + 1), F.lit(hi))).alias("_m"))
    months = months.withColumn("snapshot_month", month_label_from_index("_m"))
    return months.select("department_id", "snapshot_month",
                         F.coalesce(F.try_element_at("_h", F.col("snapshot_month")), F.lit(0)).cast("bigint").alias("headcount"))


def month_index_of(as_of) -> int:
    s = str(as_of)[:10]
    y, m = int(s[0:4]), int(s[5:7])
    return y * 12 + m - 1


def with_refresh(df: DataFrame, as_of, ts_type: str = "timestamp_ntz") -> DataFrame:
    return df.withColumn("refresh_ts", typed_timestamp(as_of, ts_type))


def monthly_status_counts(
    attendance: DataFrame,
    date_col: str = "attendance_date",
    status_col: str = "attendance_status",
    present: str = PRESENT_STATUS,
    absent: str = ABSENT_STATUS,
) -> DataFrame:
    """Days present / absent per (employee, month); ``pay_period`` = first day of the month."""
    status = F.col(status_col)
    return attendance.groupBy("employee_id", month_start(date_col).alias("pay_period")).agg(
        F.sum(F.when(status == present, 1).otherwise(0)).cast("bigint").alias("days_present"),
        F.sum(F.when(status == absent, 1).otherwise(0)).cast("bigint").alias("days_absent"),
    )


def attendance_payroll(
    payroll: DataFrame, counts: DataFrame, as_of, ts_type: str = "timestamp_ntz", normalize: bool = True
) -> DataFrame:
    """Payroll rows left-joined to monthly attendance counts, zero-filled.

    Both sides are normalised to the first day of the pay month, so a period
    given as any day of the month (or text ``yyyy-MM``) finds its month.
    ``normalize=False`` is for payroll whose ``pay_period`` is already a month
    start: the join then reuses the payroll dedupe's partitioning on
    (employee_id, pay_period) instead of shuffling payroll again.
    Each side has one row per (employee, month), so the join cannot fan out.
    """
    pay = payroll.withColumn("pay_period", month_start("pay_period")) if normalize else payroll
    return pay.join(counts, ["employee_id", "pay_period"], "left").select(
        "employee_id",
        "pay_period",
        F.coalesce("days_present", F.lit(0)).cast("bigint").alias("days_present"),
        F.coalesce("days_absent", F.lit(0)).cast("bigint").alias("days_absent"),
        "net_pay_corrected",
        "payroll_delay_days",
        typed_timestamp(as_of, ts_type).alias("refresh_ts"),
    )


def status_breakdown(table: DataFrame, status_col: str = "employment_status") -> DataFrame:
    """Current rows per status."""
    return table.filter(F.col(CURRENT)).groupBy(status_col).agg(F.count(F.lit(1)).alias("cnt"))


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows under a total order (``TakeOrderedAndProject``: each task keeps n)."""
    return df.orderBy(*order).limit(n)

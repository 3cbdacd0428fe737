"""Silver enrichment: hours, data-quality flags, recomputed pay, delay, variance profile.

Flags never drop rows: each adds a label column that is NULL when the rule
does not fire.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import (
    ABSENT_STATUSES,
    EXCESS_HOURS_LIMIT,
    LABEL_ABSENT_HAS_TIMES,
    LABEL_EXCESS_HOURS,
    LABEL_NEGATIVE_HOURS,
    LABEL_PROCESSED_EARLY,
    MONEY_TYPE,
    absent_with_times,
    days_after_period_end,
    excess_hours,
    flag,
    net_pay_corrected,
    net_pay_variance,
    work_hours,
)


def add_work_hours(df: DataFrame, check_in: str = "check_in_time", check_out: str = "check_out_time") -> DataFrame:
    """Copy the check times to ``check_in_ts``/``check_out_ts`` and add ``work_hours``.

    Text times are parsed with ``to_timestamp``; typed timestamps pass through.
    """
    def _ts(c):
        t = df.schema[c].dataType.typeName()
        return F.col(c) if t.startswith("timestamp") else F.to_timestamp(F.col(c))

    out = df.withColumns({"check_in_ts": _ts(check_in), "check_out_ts": _ts(check_out)})
    if "attendance_date" in df.columns:
        out = out.withColumn("attendance_date", F.to_date("attendance_date"))
    return out.withColumn("work_hours", work_hours("check_in_ts", "check_out_ts"))


def attendance_flags(
    df: DataFrame,
    status: str = "attendance_status",
    check_in: str = "check_in_time",
    hours: str = "work_hours",
    absent_statuses: Sequence[str] = ABSENT_STATUSES,
    hours_limit: float = EXCESS_HOURS_LIMIT,
    strict: bool = False,
) -> DataFrame:
    """``dq_status_with_times`` and ``dq_excess_hours``; strict adds ``dq_negative_hours``."""
    out = df.withColumns(
        {
            "dq_status_with_times": flag(absent_with_times(status, check_in, absent_statuses), LABEL_ABSENT_HAS_TIMES),
            "dq_excess_hours": flag(excess_hours(hours, hours_limit), LABEL_EXCESS_HOURS),
        }
    )
    if strict:
        out = out.withColumn("dq_negative_hours", flag(F.col(hours) < 0, LABEL_NEGATIVE_HOURS))
    return out


def recompute_net_pay(
    df: DataFrame,
    basic: str = "basic_salary",
    bonus: str = "bonus_amount",
    deduction: str = "deduction_amount",
    raw: str = "net_pay",
    money_type: str = MONEY_TYPE,
) -> DataFrame:
    """Cast money columns, keep the raw net pay, add corrected pay and variance."""
    return df.withColumns(
        {
            basic: F.col(basic).cast(money_type),
            bonus: F.col(bonus).cast(money_type),
            deduction: F.col(deduction).cast(money_type),
            "net_pay_raw": F.col(raw).cast(money_type),
        }
    ).withColumn(
        "net_pay_corrected", net_pay_corrected(basic, bonus, deduction, money_type)
    ).withColumn(
        "net_pay_variance", net_pay_variance("net_pay_raw", "net_pay_corrected")
    )


def add_payroll_delay(
    df: DataFrame, processed: str = "processed_date", period: str = "pay_period"
) -> DataFrame:
    """``pay_period_end``, ``payroll_delay_days`` and the early-processing flag."""
    return (
        df.withColumn(processed, F.to_date(F.col(processed)))
        .withColumn("pay_period_end", F.last_day(F.col(period)))
        .withColumn("payroll_delay_days", days_after_period_end(processed, period))
        .withColumn("dq_future_processing", flag(F.col("payroll_delay_days") < 0, LABEL_PROCESSED_EARLY))
    )


def variance_profile(
    df: DataFrame,
    col: str = "net_pay_variance",
    tolerance: float = 0.01,
    flag_cols: Sequence[str] = ("dq_future_processing",),
    digits: int = 4,
) -> DataFrame:
    """One row: typed describe() of ``col`` plus counts beyond tolerance and flagged.

    ``describe`` returns strings; this keeps numbers.  stddev is the sample
    one, as in ``describe``.  A single aggregate pass (partial + final).
    """
    c = F.col(col)
    flagged = F.lit(False)
    for f in flag_cols:
        flagged = flagged | F.col(f).isNotNull()
    return df.agg(
        F.count(c).alias("count"),
        F.round(F.avg(c), digits).cast("double").alias("mean"),
        F.round(F.stddev_samp(c), digits).cast("double").alias("stddev"),
        F.min(c).alias("min"),
        F.max(c).alias("max"),
        F.count_if(F.abs(c) > F.lit(tolerance)).alias("beyond_tolerance"),
        F.count_if(flagged).alias("flagged"),
        F.count(F.lit(1)).alias("rows"),
    )


def cast_or_reject(
    df: DataFrame, types: dict[str, str], reason: str = "bad_value", strict: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Type text columns; rows whose value does not parse go to a rejected output.

    strict: ``try_cast`` each column; a row is rejected (with ``rejection_reason``
    and ``bad_columns``) when a non-NULL input becomes NULL.  Not strict: a
    plain ``cast``, which under ANSI mode raises on the first bad value (the
    reference's behaviour), and the rejected output is empty.
    One projection and two filters of the same plan; no shuffle.
    """
    if not strict:
        typed = df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})
        return typed, typed.limit(0).withColumn("rejection_reason", F.lit(reason))
    bad = [F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), F.lit(c)) for c, t in types.items()]
    marked = df.withColumn("bad_columns", F.concat_ws(",", *bad))
    is_bad = F.col("bad_columns") != ""
    typed = marked.filter(~is_bad).drop("bad_columns").withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})
    rejected = marked.filter(is_bad).withColumn("rejection_reason", F.lit(reason))
    return typed, rejected

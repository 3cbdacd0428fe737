"""Column expressions: built-in Spark functions only, so every rule stays inside codegen."""

from strata.functions.columns import (
    absent_with_times,
    as_column,
    change_predicate,
    days_after_period_end,
    excess_hours,
    flag,
    month_end_midnight,
    month_index,
    month_label,
    month_label_from_index,
    month_start,
    net_pay_corrected,
    net_pay_variance,
    typed_timestamp,
    work_hours,
)

__all__ = [
    "absent_with_times",
    "as_column",
    "change_predicate",
    "days_after_period_end",
    "excess_hours",
    "flag",
    "month_end_midnight",
    "month_index",
    "month_label",
    "month_label_from_index",
    "month_start",
    "net_pay_corrected",
    "net_pay_variance",
    "typed_timestamp",
    "work_hours",
]

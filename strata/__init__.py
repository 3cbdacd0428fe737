"""strata: bronze / silver / gold table operators as plain Spark DataFrame functions.

Every operator takes its run id, run date and as-of time as arguments, so the
same inputs always give the same outputs.  Nothing here reads the wall clock.
"""

from strata.operators.audit import audit_row, counted, table_counts
from strata.operators.bronze import ingest_bronze, latest_from_bronze, read_bronze, runs_summary, stamp_lineage, stored_runs
from strata.operators.dedupe import latest_by, split_duplicates, stage
from strata.operators.gold import (
    attendance_payroll,
    headcount_history,
    month_spine,
    monthly_status_counts,
    status_breakdown,
    workforce_summary,
)
from strata.operators.quality import (
    add_payroll_delay,
    add_work_hours,
    attendance_flags,
    cast_or_reject,
    recompute_net_pay,
    variance_profile,
)
from strata.operators.scd2 import scd2_apply, scd2_as_of, scd2_changes, scd2_expire, scd2_init, scd2_new_keys
from strata.operators.snapshots import (
    clustered,
    compare_partitions,
    read_partition,
    write_partition,
)

__version__ = "0.1.0"

__all__ = [
    "add_payroll_delay", "add_work_hours", "attendance_flags", "attendance_payroll", "audit_row",
    "cast_or_reject", "clustered", "compare_partitions", "counted", "headcount_history", "ingest_bronze",
    "latest_by", "latest_from_bronze", "month_spine", "monthly_status_counts", "read_bronze", "read_partition",
    "recompute_net_pay", "runs_summary", "scd2_apply", "scd2_as_of", "scd2_changes", "scd2_expire",
    "scd2_init", "scd2_new_keys", "split_duplicates", "stage", "stamp_lineage", "status_breakdown", "stored_runs", "table_counts",
    "variance_profile", "workforce_summary", "write_partition",
]

"""End-to-end run over a folder tree: landing CSV -> bronze -> silver -> gold -> reports -> audit.

Layout under ``base`` (a shared file system path)::

    raw/<entity>/<run_date>/*.csv             landed files (``land_csv``, or from outside)
    bronze/<entity>/_run_id=<run>/            append-only history, one folder per run
    latest/<entity>/                          latest row per source id (``latest_state``)
    silver/<entity>/_as_of=<time>/            one folder per run
    silver/employee/_as_of=<time>/            type-2 table (``scd2_store``)
    rejected/{attendance,payroll}/_run_id=<run>/
    gold/<report>/_as_of=<time>/
    audit/_run_id=<run>/                      one row per run

A table is declared with the tables it reads; the run order follows from that.
A failing table is recorded, whatever reads it is skipped (and what reads that),
so reports keep the last good run and nothing is published from a table that
was not made.  The audit row lists both, with counts observed in the writes,
and the run raises at the end if any table failed.  Every step takes the run's
parameters; only the audit start and end times read a clock (``clock``,
replaceable).
"""

from __future__ import annotations

import datetime as _dt
import graphlib
import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import gold, latest_state, quality, runs, scd2_store, snapshots
from strata.operators.audit import audit_row, counted, narrow_counts
from strata.operators.bronze import append_run, stamp_lineage
from strata.operators.dedupe import split_duplicates
from strata.plans.standins import ATT_REJECT_COLS, PAY_REJECT_COLS
from strata.session import staging
from strata.sources.files import read_landed
from strata.sources.jdbc import publish_run

# Fixed values that must equal the reference's for the same results.
SCHEMAS = {
    "attendance": "attendance_id BIGINT, employee_id STRING, attendance_date DATE, attendance_status STRING, "
                  "check_in_time TIMESTAMP, check_out_time TIMESTAMP",
    "payroll": "payroll_id BIGINT, employee_id STRING, pay_period DATE, basic_salary DECIMAL(18,2), "
               "bonus_amount DECIMAL(18,2), deduction_amount DECIMAL(18,2), net_pay DECIMAL(18,2), "
               "processed_date DATE",
    "employee": "employee_id STRING, department_id STRING, designation STRING, manager_id STRING, "
                "salary DECIMAL(18,2), employment_status STRING, hire_date DATE",
    "department": "department_id STRING, department_name STRING, business_unit STRING, location STRING, "
                  "active_status STRING, last_updated STRING",
}
AUDIT_TABLE = "dbo.pipeline_audit"
REPORT_TABLES = (
    ("dbo.rpt_workforce_summary", "gold/workforce_summary"),
    ("dbo.rpt_dept_headcount_history", "gold/dept_headcount_history"),
    ("dbo.rpt_attendance_payroll", "gold/attendance_payroll"),
)
CLUSTER_COLUMNS = {
    "employee": ("department_id", "employee_id"),
    "payroll": ("employee_id", "pay_period"),
    "attendance": ("employee_id", "attendance_date"),
}
GOLD_FOLDERS = {"gold_headcount_history": "dept_headcount_history"}  # where not the task's own name


@dataclass
class RunParams:
    base: str
    run_id: str
    run_date: str                 # landing folder date, yyyy-MM-dd
    as_of: str                    # ingest / SCD2 / refresh time, 'yyyy-MM-dd HH:mm:ss'
    n_months: int = 12
    strict: bool = False          # repaired behaviour (null keys rejected, null-safe changes)
    jdbc_url: str | None = None
    jdbc_props: Mapping[str, str] = field(default_factory=dict)
    cluster: bool = False         # write silver tables in value ranges of CLUSTER_COLUMNS
    buckets: int = 32             # of the latest-row state and the type-2 table; a table keeps its first number
    execute: Callable | None = None  # runs SQL statements as one transaction; by default over JDBC
    clock: Callable[[], _dt.datetime] = field(default=lambda: _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None))

    def path(self, *parts: str) -> str:
        return "/".join([self.base.rstrip("/"), *parts])


def _bronze(spark: SparkSession, p: RunParams, entity: str) -> int:
    """Land -> Bronze.  Parity: typed read that fails on a value that does not
    parse (as a cast does under ANSI).  Strict: read text, type with
    ``try_cast`` and send unparseable rows to ``rejected/<entity>_values``."""
    src = p.path("raw", entity, p.run_date)
    if p.strict:
        schema = spark.createDataFrame([], SCHEMAS[entity]).schema
        text = read_landed(spark, src, schema=", ".join(f"{f.name} STRING" for f in schema.fields))
        raw, bad = quality.cast_or_reject(text, {f.name: f.dataType.simpleString() for f in schema.fields})
        _append_rejected(stamp_lineage(bad, p.run_id, p.as_of), p.path("rejected", f"{entity}_values"), p.run_id)
    else:
        raw = read_landed(spark, src, schema=SCHEMAS[entity], mode="FAILFAST")
    return append_run(stamp_lineage(raw, p.run_id, p.as_of), p.path("bronze", entity), p.run_id)


def _latest(spark: SparkSession, p: RunParams, entity: str, key: str) -> DataFrame:
    """Latest Bronze row per source id: the state folds in the runs that are new or changed."""
    return latest_state.fold(spark, p.path("bronze", entity), p.path("latest", entity), key, buckets=p.buckets)


def _clustered(df: DataFrame, p: RunParams, entity: str) -> DataFrame:
    return snapshots.clustered(df, list(CLUSTER_COLUMNS[entity]), 128 << 20, 64) if p.cluster else df


def _put(df: DataFrame, p: RunParams, *table: str) -> int:
    return snapshots.write_partition(df, p.path(*table), p.as_of)


def _get(spark: SparkSession, p: RunParams, *table: str) -> DataFrame:
    """This run's version of a table; raises where the run has not made it."""
    return snapshots.read_partition(spark, p.path(*table), p.as_of)


def _append_rejected(df: DataFrame, path: str, run_id: str) -> int:
    """Rejected rows of this run, in this run's folder (re-runs replace it).

    The row's own Bronze run id is kept as ``_ingest_run_id``.
    """
    return append_run(df.withColumnRenamed("_run_id", "_ingest_run_id"), path, run_id)


def silver_attendance(spark: SparkSession, p: RunParams) -> Counts:
    df = quality.attendance_flags(quality.add_work_hours(_latest(spark, p, "attendance", "attendance_id")),
                                  strict=p.strict)
    clean, rejected = split_duplicates(
        df, ["employee_id", "attendance_date"], [F.desc("attendance_id")], "duplicate_attendance",
        reject_columns=ATT_REJECT_COLS, null_key_reason="null_key" if p.strict else None,
    )
    bad = _append_rejected(rejected, p.path("rejected", "attendance"), p.run_id)
    return Counts(_put(_clustered(clean, p, "attendance"), p, "silver", "attendance"), bad)


def silver_payroll(spark: SparkSession, p: RunParams) -> Counts:
    df = quality.add_payroll_delay(quality.recompute_net_pay(_latest(spark, p, "payroll", "payroll_id")))
    clean, rejected = split_duplicates(
        df, ["employee_id", "pay_period"], [F.desc("processed_date"), F.desc("payroll_id")], "duplicate_pay_period",
        reject_columns=PAY_REJECT_COLS, null_key_reason="null_key" if p.strict else None,
    )
    bad = _append_rejected(rejected, p.path("rejected", "payroll"), p.run_id)
    return Counts(_put(_clustered(clean, p, "payroll"), p, "silver", "payroll"), bad)


def silver_employee(spark: SparkSession, p: RunParams) -> Counts:
    """Type-2 table: a run writes the buckets that hold a changed key; its size comes from file footers."""
    snap = _latest(spark, p, "employee", "employee_id").drop("_ingest_ts", "_source_file", "_run_id")
    snap = snap.withColumns({"hire_date": F.to_date("hire_date"), "salary": F.col("salary").cast("decimal(18,2)")})
    store = p.path("silver", "employee")
    scd2_store.apply_run(snap, store, p.as_of, "employee_id", null_safe=p.strict, null_keys="reject" if p.strict else "insert",
                         buckets=p.buckets)
    return Counts(scd2_store.row_count(spark, store, p.as_of))


def silver_department(spark: SparkSession, p: RunParams) -> None:
    _put(_latest(spark, p, "department", "department_id"), p, "silver", "department")


def _employees(spark: SparkSession, p: RunParams) -> DataFrame:
    return scd2_store.read(spark, p.path("silver", "employee"), p.as_of)


def gold_workforce(spark: SparkSession, p: RunParams) -> None:
    dept = _get(spark, p, "silver", "department")
    _put(gold.workforce_summary(_employees(spark, p), dept, p.as_of), p, "gold", "workforce_summary")


def gold_headcount(spark: SparkSession, p: RunParams) -> None:
    hc = gold.headcount_history(_employees(spark, p), spark, p.as_of, p.n_months)
    _put(gold.with_refresh(hc, p.as_of), p, "gold", "dept_headcount_history")


def gold_attendance_payroll(spark: SparkSession, p: RunParams) -> None:
    counts = gold.monthly_status_counts(_get(spark, p, "silver", "attendance"))
    _put(gold.attendance_payroll(_get(spark, p, "silver", "payroll"), counts, p.as_of), p, "gold", "attendance_payroll")


def publish(spark: SparkSession, p: RunParams, table: str, report: str) -> None:
    if p.jdbc_url:
        publish_run(_get(spark, p, report), p.jdbc_url, table, p.run_id, p.jdbc_props, execute=p.execute)


@dataclass(frozen=True)
class Task:
    """How a table (or the reports) is made, and which tables that reads."""

    make: Callable[[SparkSession, RunParams], object]
    reads: tuple[str, ...] = ()


@dataclass(frozen=True)
class Counts:
    """Rows of a silver table after its write, and rows the write rejected."""

    rows: int
    rejected: int = 0


def tasks() -> dict[str, Task]:
    """Every table of the run by name; nothing here says in which order they are made."""
    out = {f"bronze_{e}": Task(lambda s, p, e=e: _bronze(s, p, e)) for e in SCHEMAS}
    out |= {
        "gold_attendance_payroll": Task(gold_attendance_payroll, ("silver_attendance", "silver_payroll")),
        "gold_headcount_history": Task(gold_headcount, ("silver_employee",)),
        "gold_workforce_summary": Task(gold_workforce, ("silver_employee", "silver_department")),
    }
    makers = {"attendance": silver_attendance, "payroll": silver_payroll, "employee": silver_employee,
              "department": silver_department}
    out |= {f"silver_{e}": Task(f, (f"bronze_{e}",)) for e, f in makers.items()}
    for table, report in REPORT_TABLES:
        made = next(k for k in out if k.startswith("gold_") and report.endswith(GOLD_FOLDERS.get(k, k.removeprefix("gold_"))))
        out[f"publish_{report.split('/')[-1]}"] = Task(lambda s, p, t=table, r=report: publish(s, p, t, r), (made,))
    return out


def run_order(todo: Mapping[str, Task]) -> list[str]:
    """Names such that each comes after all it reads; by name where that leaves a choice."""
    sorter = graphlib.TopologicalSorter({k: t.reads for k, t in todo.items()})
    sorter.prepare()
    out: list[str] = []
    while sorter.is_active():
        ready = sorted(sorter.get_ready())
        out += ready
        sorter.done(*ready)
    return out


@dataclass
class Outcome:
    table: str
    seconds: float
    error: str | None = None
    skipped: bool = False
    counts: Counts | None = None

    @property
    def status(self) -> str:
        return "SKIPPED" if self.skipped else "FAILED" if self.error is not None else "SUCCESS"


#: Tables whose rows the audit row sums.
AUDITED = ("silver_attendance", "silver_payroll", "silver_employee")


def run_audit(spark: SparkSession, p: RunParams, start: _dt.datetime, end: _dt.datetime, outcomes: list[Outcome]) -> DataFrame:
    """The audit row from what the writes observed; a table that failed or was skipped counts 0."""
    known = {o.table: o.counts for o in outcomes if o.table in AUDITED and o.counts is not None}
    counts = counted(spark, {k: c.rows for k, c in known.items()}, {k: c.rejected for k, c in known.items()})
    return audit_row(counts, p.run_id, start.isoformat(sep=" "), end.isoformat(sep=" "),
                     [o.table for o in outcomes if o.status == "FAILED"], [o.table for o in outcomes if o.skipped], ts_type="timestamp")


def run_all(spark: SparkSession, p: RunParams, raise_on_failure: bool = True) -> tuple[list[Outcome], DataFrame]:
    """Make every table in dependency order; returns the outcome of each, and the audit row."""
    todo, done, start = tasks(), {}, p.clock()
    for name in run_order(todo):
        missing = [r for r in todo[name].reads if done[r].status != "SUCCESS"]
        if missing:
            done[name] = Outcome(name, 0.0, "needs " + ", ".join(missing), skipped=True)
            continue
        began, error, made = time.perf_counter(), None, None
        try:
            with staging(spark):  # a task has written what it returns
                made = todo[name].make(spark, p)
        except Exception as e:  # noqa: BLE001 - recorded; tables that do not need this one are still made
            error = str(e)
        done[name] = Outcome(name, time.perf_counter() - began, error, counts=made if isinstance(made, Counts) else None)
    outcomes = list(done.values())
    failed = [o.table for o in outcomes if o.status == "FAILED"]
    audit = run_audit(spark, p, start, p.clock(), outcomes)
    runs.write_run(audit.withColumn(runs.RUN_ID, F.col("run_id")), p.path("audit"), p.run_id)
    stored = runs.read_run(spark, p.path("audit"), p.run_id)
    if p.jdbc_url:
        publish_run(narrow_counts(stored), p.jdbc_url, AUDIT_TABLE, p.run_id, p.jdbc_props, run_column="run_id", execute=p.execute)
    if failed and raise_on_failure:
        raise RuntimeError(f"{len(failed)} tables failed: {', '.join(failed)}")
    return outcomes, stored


def main(argv: list[str] | None = None) -> None:
    """``python -m strata.plans.orchestrate --base B --run-id R --run-date D --as-of T [--strict]``.

    Uses the active (or default) SparkSession; its ``spark.checkpoint.dir``
    should name a shared folder on a cluster.
    """
    import argparse

    ap = argparse.ArgumentParser(description="landing -> bronze -> silver -> gold -> reports -> audit")
    ap.add_argument("--base", required=True)
    ap.add_argument("--run-id", required=True)
    ap.add_argument("--run-date", required=True, help="landing folder date, yyyy-MM-dd")
    ap.add_argument("--as-of", required=True, help="'yyyy-MM-dd HH:mm:ss'")
    ap.add_argument("--months", type=int, default=12)
    ap.add_argument("--buckets", type=int, default=32)
    ap.add_argument("--strict", action="store_true")
    ap.add_argument("--jdbc-url")
    ap.add_argument("--cluster", action="store_true", help="write silver tables in value ranges")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    from strata.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    params = RunParams(a.base, a.run_id, a.run_date, a.as_of, a.months, a.strict, a.jdbc_url, cluster=a.cluster, buckets=a.buckets)
    outcomes, audit = run_all(spark, params)
    for o in outcomes:
        print(f"{o.status:8s} {o.seconds:7.1f}s {o.table}")
    audit.show(truncate=False)


if __name__ == "__main__":
    main()

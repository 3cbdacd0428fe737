"""Property tests against brute force on small random inputs."""

import calendar
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.operators import gold
from strata.operators.dedupe import split_duplicates

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def month_end(y, m):
    return dt.datetime(y, m, calendar.monthrange(y, m)[1])


# timestamps clustered on month ends: midnight, 09:00 and one second either side
near_month_end = st.builds(
    lambda y, m, off: month_end(y, m) + off,
    st.integers(2025, 2026), st.integers(1, 12),
    st.sampled_from([dt.timedelta(0), dt.timedelta(hours=9), dt.timedelta(seconds=1), dt.timedelta(seconds=-1),
                     dt.timedelta(days=-10)]),
)
version = st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from(["Active", "Resigned"]), near_month_end,
                    st.one_of(st.none(), near_month_end))


def brute_headcount(rows, as_of, n):
    y, m = as_of.year, as_of.month
    months = []
    for _ in range(n):
        months.append((y, m))
        y, m = (y, m - 1) if m > 1 else (y - 1, 12)
    out = {}
    for dept, status, frm, to in rows:
        if status != "Active":
            continue
        for (yy, mm) in months:
            me = month_end(yy, mm)
            if frm <= me and (to is None or to > me):
                key = (dept, f"{yy:04d}-{mm:02d}")
                out[key] = out.get(key, 0) + 1
    return out


@SETTINGS
@given(rows=st.lists(version, min_size=1, max_size=12))
def test_headcount_plans_match_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "department_id STRING, employment_status STRING, "
                                     "effective_from TIMESTAMP_NTZ, effective_to TIMESTAMP_NTZ")
    as_of = dt.date(2026, 12, 15)
    want = brute_headcount(rows, as_of, 30)
    for plan in ("expand", "range_join", "sweep"):
        got = {(r.department_id, r.snapshot_month): r.headcount
               for r in gold.headcount_history(df, spark, as_of, 30, plan=plan).collect()}
        assert got == want, plan


dup_row = st.tuples(st.sampled_from(["k1", "k2", None]), st.integers(0, 3), st.integers(0, 2))


@SETTINGS
@given(rows=st.lists(dup_row, min_size=1, max_size=15))
def test_split_duplicates_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k STRING, v INT, w INT")
    clean, rej = split_duplicates(df, ["k"], [F.desc("v")], "dup")

    def key(t):
        return tuple(("", x) if x is None else ("v", x) for x in t)

    got_clean = sorted((tuple(r) for r in clean.collect()), key=key)
    got_rej = sorted((tuple(r)[:3] for r in rej.collect()), key=key)
    # brute force: per key, the winner has the highest v; among equal v the tiebreak is unspecified,
    # so compare per key: the clean v is the max, and clean + rejected is the input multiset
    by_key = {}
    for r in rows:
        by_key.setdefault(r[0], []).append(r)
    assert len(got_clean) == len(by_key)
    for k, g in by_key.items():
        win = [c for c in got_clean if c[0] == k]
        assert len(win) == 1 and win[0][1] == max(x[1] for x in g)
    assert sorted(got_clean + got_rej, key=key) == sorted(rows, key=key)


def brute_scd2(table, incoming, t1, null_safe):
    """The reference's algorithm, row by row: changed keys, expire, insert new and changed."""
    def differs(a, b):
        if null_safe:
            return a != b
        return a is not None and b is not None and a != b  # SQL <>: NULL is not a change

    current = [r for r in table if r[4]]
    inc_by_key = {}
    for r in incoming:
        inc_by_key.setdefault(r[0], []).append(r)
    changed = set()
    for c in current:
        for s in inc_by_key.get(c[0], []) if c[0] is not None else []:
            if differs(c[1], s[1]) or differs(c[2], s[2]):
                changed.add(c[0])
    out = []
    for r in table:
        if r[4] and r[0] is not None and r[0] in changed:
            out.append((r[0], r[1], r[2], r[3], False, t1))
        else:
            out.append(r + (None,) if len(r) == 5 else r)
    current_keys = {c[0] for c in current if c[0] is not None}
    for s in incoming:
        if s[0] is None or s[0] not in current_keys or s[0] in changed:
            out.append((s[0], s[1], s[2], T1_TS, True, None))
    return out


T0_TS, T1_TS = dt.datetime(2026, 1, 1), dt.datetime(2026, 2, 1)
cell = st.one_of(st.none(), st.sampled_from(["x", "y"]))


@SETTINGS
@given(
    keys=st.lists(st.sampled_from(["1", "2", "3", "4", None]), min_size=0, max_size=5),
    cur_vals=st.lists(st.tuples(cell, cell), min_size=5, max_size=5),
    inc_keys=st.lists(st.sampled_from(["1", "2", "3", "5", None]), min_size=0, max_size=5, unique=True),
    inc_vals=st.lists(st.tuples(cell, cell), min_size=5, max_size=5),
    null_safe=st.booleans(),
)
def test_scd2_apply_matches_reference_algorithm(spark, keys, cur_vals, inc_keys, inc_vals, null_safe):
    from strata.operators import scd2

    seen, table = set(), []
    for i, k in enumerate(keys):
        current = k is None or k not in seen  # one current row per non-null key
        seen.add(k)
        table.append((k, cur_vals[i][0], cur_vals[i][1], T0_TS, current,
                      None if current else dt.datetime(2025, 12, 1)))
    incoming = [(k, inc_vals[i][0], inc_vals[i][1]) for i, k in enumerate(inc_keys)]
    schema = "employee_id STRING, a STRING, b STRING, effective_from TIMESTAMP_NTZ, is_current BOOLEAN, " \
             "effective_to TIMESTAMP_NTZ"
    t = spark.createDataFrame(table, schema)
    s = spark.createDataFrame(incoming, "employee_id STRING, a STRING, b STRING")
    got = scd2.scd2_apply(t, s, "employee_id", "2026-02-01 00:00:00", tracked=("a", "b"), null_safe=null_safe)
    cols = ["employee_id", "a", "b", "effective_from", "is_current", "effective_to"]
    got_rows = [tuple(r) for r in got.select(cols).collect()]
    want = brute_scd2(table, incoming, T1_TS, null_safe)

    def key(t):
        return tuple(("", "") if x is None else ("v", str(x)) for x in t)

    assert sorted(got_rows, key=key) == sorted(want, key=key)

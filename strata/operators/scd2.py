"""Type-2 slowly changing dimension as DataFrame rewrites.

The table carries ``effective_from``, ``effective_to`` (NULL = open) and
``is_current``.  ``scd2_apply`` returns the whole next version of the table:

* history rows (not current) pass through untouched, outside any join;
* current rows and incoming rows meet in one full outer join on the key;
  changed keys emit the closed old row and the new row, unchanged keys the
  old row, incoming-only keys a new row, current-only keys the old row
  (or a closed one with ``close_missing``);
* rows with a NULL key never match in an equi-join, so they bypass the join
  too (no NULL-key hot partition).  Parity inserts incoming NULL-key rows on
  every run; ``null_keys="reject"`` leaves them out.

Both sides of the join hold one row per key (the incoming snapshot comes from
``latest_by``; the table has one current row per key), so the join cannot
skew.  One ``as_of`` value closes old rows and opens new ones, so intervals
meet without gaps.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import change_predicate, typed_timestamp

FROM, TO, CURRENT = "effective_from", "effective_to", "is_current"
INTERVAL_COLS = (FROM, TO, CURRENT)
# Fixed values that must equal the reference's for the same results.
TRACKED_COLUMNS = ("department_id", "designation", "manager_id", "salary", "employment_status")


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _any_null(keys: Sequence[str], prefix: str = "") -> Column:
    out = F.lit(False)
    for k in keys:
        out = out | F.col(f"{prefix}{k}").isNull()
    return out


def scd2_init(snapshot: DataFrame, as_of, ts_type: str = "timestamp_ntz") -> DataFrame:
    """First version: every snapshot row current from ``as_of``."""
    return snapshot.withColumns(
        {
            FROM: typed_timestamp(as_of, ts_type),
            TO: F.lit(None).cast(ts_type),
            CURRENT: F.lit(True),
        }
    )


def current_rows(table: DataFrame) -> DataFrame:
    """Rows with ``is_current`` true (NULL counts as not current, and is kept as history)."""
    return table.filter(F.coalesce(F.col(CURRENT), F.lit(False)))


def scd2_changes(
    table: DataFrame, incoming: DataFrame, key: str | Sequence[str], tracked: Sequence[str] = TRACKED_COLUMNS,
    null_safe: bool = False,
) -> DataFrame:
    """Keys whose tracked columns differ between the current row and the incoming row."""
    keys = _keys(key)
    cond = [F.col(f"c.{k}") == F.col(f"s.{k}") for k in keys]
    return (
        current_rows(table).alias("c")
        .join(incoming.alias("s"), cond, "inner")
        .filter(change_predicate(tracked, "c", "s", null_safe))
        .select(*[F.col(f"c.{k}").alias(k) for k in keys])
    )


def scd2_new_keys(table: DataFrame, incoming: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Incoming rows whose key has no current row (NULL keys always qualify, outside the join)."""
    keys = _keys(key)
    cur = current_rows(table).select(*keys).filter(~_any_null(keys))
    new = incoming.filter(~_any_null(keys)).join(cur, keys, "left_anti")
    return new.unionByName(incoming.filter(_any_null(keys)))


def scd2_expire(table: DataFrame, changed_keys: DataFrame, key: str | Sequence[str], as_of,
                ts_type: str = "timestamp_ntz") -> DataFrame:
    """Conditional update: current rows of ``changed_keys`` get ``is_current=false``, ``effective_to=as_of``.

    History rows and NULL keys bypass the join; ``changed_keys`` is made
    distinct first so the join never multiplies rows.
    """
    keys = _keys(key)
    ts = typed_timestamp(as_of, ts_type)
    hits = changed_keys.select(*keys).distinct().withColumn("_hit", F.lit(True))
    cur = current_rows(table).filter(~_any_null(keys)).join(hits.filter(~_any_null(keys)), keys, "left")
    hit = F.col("_hit").isNotNull()
    updated = cur.withColumns(
        {CURRENT: F.when(hit, F.lit(False)).otherwise(F.col(CURRENT)),
         TO: F.when(hit, ts).otherwise(F.col(TO))}
    ).drop("_hit").select(*table.columns)
    rest = table.filter(~F.coalesce(F.col(CURRENT), F.lit(False)) | _any_null(keys))
    return rest.unionByName(updated)


def scd2_apply(
    table: DataFrame,
    incoming: DataFrame,
    key: str | Sequence[str],
    as_of,
    tracked: Sequence[str] = TRACKED_COLUMNS,
    null_safe: bool = False,
    close_missing: bool = False,
    null_keys: str = "insert",
    ts_type: str = "timestamp_ntz",
) -> DataFrame:
    """Next version of ``table`` after applying the ``incoming`` snapshot at ``as_of``.

    ``incoming`` holds the dimension's columns without the interval columns,
    one row per key.  ``null_safe`` counts NULL <-> value as a change;
    ``close_missing`` closes current rows whose key is absent from the
    snapshot; ``null_keys`` is ``"insert"`` (parity) or ``"reject"``.
    """
    keys = _keys(key)
    ts = typed_timestamp(as_of, ts_type)
    inc = incoming.drop(*[c for c in INTERVAL_COLS if c in incoming.columns]).withColumns(
        {FROM: ts, TO: F.lit(None).cast(ts_type), CURRENT: F.lit(True)}
    )
    t_types = {f.name: f.dataType for f in table.schema.fields}
    i_types = {f.name: f.dataType for f in inc.schema.fields}
    out_cols = list(table.columns) + [c for c in inc.columns if c not in t_types]

    is_cur = F.coalesce(F.col(CURRENT), F.lit(False))
    history = table.filter(~is_cur)
    current = table.filter(is_cur)
    cur_null, cur = current.filter(_any_null(keys)), current.filter(~_any_null(keys))
    inc_null, inc_ok = inc.filter(_any_null(keys)), inc.filter(~_any_null(keys))

    cond = [F.col(f"c.{k}") == F.col(f"s.{k}") for k in keys]
    j = cur.withColumn("_c", F.lit(True)).alias("c").join(
        inc_ok.withColumn("_s", F.lit(True)).alias("s"), cond, "full_outer"
    )
    has_c, has_s = F.col("c._c").isNotNull(), F.col("s._s").isNotNull()
    changed = has_c & has_s & change_predicate(tracked, "c", "s", null_safe)
    close = changed | (has_c & ~has_s) if close_missing else changed

    def typed(side: str, name: str, types: dict) -> Column:
        target = t_types.get(name) or i_types[name]
        if name in types:
            return F.col(f"{side}.{name}").cast(target)
        return F.lit(None).cast(target)

    c_fields = []
    for n in out_cols:
        if n == CURRENT:
            c_fields.append(F.when(close, F.lit(False)).otherwise(F.col(f"c.{CURRENT}")).alias(n))
        elif n == TO:
            c_fields.append(F.when(close, ts).otherwise(F.col(f"c.{TO}")).alias(n))
        else:
            c_fields.append(typed("c", n, t_types).alias(n))
    s_fields = [typed("s", n, i_types).alias(n) for n in out_cols]
    emit_c = has_c
    emit_s = has_s & (~has_c | changed)
    versions = j.select(
        F.inline(
            F.array(
                F.struct(*c_fields, emit_c.alias("_emit")),
                F.struct(*s_fields, emit_s.alias("_emit")),
            )
        )
    ).filter(F.col("_emit")).drop("_emit")

    parts = [history.select(*[typed_plain(n, t_types, table) for n in out_cols]),
             cur_null.select(*[typed_plain(n, t_types, table) for n in out_cols]),
             versions]
    if null_keys == "insert":
        parts.append(inc_null.select(*[typed_plain(n, t_types, inc, i_types) for n in out_cols]))
    elif null_keys != "reject":
        raise ValueError("null_keys must be 'insert' or 'reject'")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def typed_plain(name: str, t_types: dict, df: DataFrame, own_types: dict | None = None) -> Column:
    """Column ``name`` of ``df`` cast to the table's type, or a typed NULL if absent."""
    own = own_types if own_types is not None else {f.name: f.dataType for f in df.schema.fields}
    target = t_types.get(name) or own[name]
    if name in df.columns:
        return F.col(name).cast(target).alias(name)
    return F.lit(None).cast(target).alias(name)


def scd2_as_of(table: DataFrame, ts, ts_type: str = "timestamp_ntz") -> DataFrame:
    """Versions valid at ``ts``: ``from <= ts AND (to IS NULL OR to > ts)``."""
    t = typed_timestamp(ts, ts_type)
    return table.filter((F.col(FROM) <= t) & (F.col(TO).isNull() | (F.col(TO) > t)))

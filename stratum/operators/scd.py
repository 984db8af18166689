"""Slowly changing dimensions, type 1 and type 2, without MERGE.

Both are expressed as plain DataFrame plans:

* ``latest_per_key`` is a ``groupBy(keys).agg(max_by(...))``: map-side
  partial aggregation collapses a hot key before the shuffle, so a key that
  holds a third of all rows never lands in one task as raw rows (a
  ``row_number()`` window would sort all of them in one task).
* SCD1 = latest per key over (target UNION source) with the source preferred:
  one shuffle, no join.
* SCD2 = ONE full-outer join between the current dimension rows and the
  latest source row per key (both sides unique per key, so no skew), then a
  projection that emits the old and/or new image of each key.  History rows
  are passed through with a narrow union.

Dates: ``effective_start`` / ``effective_end`` are ``date`` values and the
interval is half-open ``[start, end)``; ``effective_end`` is null on the
current row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratum.schemas import SCD2_CURRENT, SCD2_END, SCD2_START

CLASS_COL = "_change"
# Change classes of an SCD2 apply.
NEW, CHANGED, UNCHANGED, MISSING = "new", "changed", "unchanged", "missing"


def _cols(cs: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] = (),
                   latest: bool = True) -> DataFrame:
    """One row per key: the row with the greatest ``order_by`` tuple.

    Ties on ``order_by`` are broken by the remaining columns, so the result is
    deterministic.  Rows whose key is null form their own group (like
    ``groupBy``).  ``latest=False`` picks the smallest tuple instead.

    Spark plans ``max_by`` over a struct as a sort-based aggregate (there is no
    fixed-width hash buffer for a struct); it is still partial, so each map
    task sends at most one row per key to the shuffle.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    order = F.struct(*_cols(order_by), *[F.col(c) for c in rest])
    value = F.struct(*[F.col(c) for c in rest])
    pick = F.max_by if latest else F.min_by
    return df.groupBy(*keys).agg(pick(value, order).alias("__row")).select(*keys, "__row.*")


def scd1_apply(target: DataFrame | None, source: DataFrame, keys: Sequence[str],
               order_by: Sequence[str | Column] = (), compete: bool = False) -> DataFrame:
    """Type 1 upsert: one current row per key, no history.

    A key in the source replaces the target row (update all columns); a new key
    is inserted; target keys absent from the source stay.  Several source rows
    per key: the greatest ``order_by`` tuple wins.  With ``compete=True`` the
    target row competes on ``order_by`` too, so a late, older source row never
    overwrites newer data (order-independent, safe for out-of-order streams).
    """
    order = list(order_by)
    if target is None:
        return latest_per_key(source, keys, order)
    prio = "__src"
    both = target.withColumn(prio, F.lit(0)).unionByName(
        source.withColumn(prio, F.lit(1)), allowMissingColumns=True)
    ranking = [*order, prio] if compete else [prio, *order]
    return latest_per_key(both, keys, ranking).drop(prio)


def scd2_initial(source: DataFrame, keys: Sequence[str], effective_date,
                 order_by: Sequence[str | Column] = ()) -> DataFrame:
    """First load: latest row per key, all current from ``effective_date``."""
    src = latest_per_key(source, keys, order_by)
    return src.withColumns({
        SCD2_START: F.lit(str(effective_date)).cast("date"),
        SCD2_END: F.lit(None).cast("date"),
        SCD2_CURRENT: F.lit(True),
    })


def scd2_classify(target: DataFrame, source: DataFrame, keys: Sequence[str],
                  track: Sequence[str], order_by: Sequence[str | Column] = (),
                  null_safe: bool = True) -> DataFrame:
    """Full-outer join of current rows and latest source rows, classified.

    Output: keys, ``_change`` in (new, changed, unchanged, missing), and
    structs ``t`` (current target row) and ``s`` (source row).  Keys are
    compared null-safe.
    """
    keys = list(keys)
    current = target.filter(F.col(SCD2_CURRENT))
    src = latest_per_key(source, keys, order_by)
    t_cols = [c for c in current.columns if c not in keys]
    s_cols = [c for c in src.columns if c not in keys]
    tk = [f"__tk{i}" for i in range(len(keys))]
    sk = [f"__sk{i}" for i in range(len(keys))]
    t = current.select(*[F.col(k).alias(a) for k, a in zip(keys, tk)],
                       F.struct(*t_cols).alias("t"), F.lit(True).alias("__t"))
    s = src.select(*[F.col(k).alias(a) for k, a in zip(keys, sk)],
                   F.struct(*s_cols).alias("s"), F.lit(True).alias("__s"))
    # Null-safe key equality: a null key is one key (as in ``latest_per_key``)
    # instead of a fresh insert on every apply.  Spark plans ``<=>`` keys as an
    # ordinary sort-merge equi-join.
    cond = None
    for a, b in zip(tk, sk):
        eq = F.col(a).eqNullSafe(F.col(b))
        cond = eq if cond is None else cond & eq
    j = t.join(s, cond, "full_outer").select(
        *[F.coalesce(F.col(a), F.col(b)).alias(k) for k, a, b in zip(keys, tk, sk)],
        "t", "s", "__t", "__s")
    flat_t = {c: F.col(f"t.{c}") for c in t_cols}
    flat_s = {c: F.col(f"s.{c}") for c in s_cols}
    klass = (
        F.when(F.col("__t").isNull(), F.lit(NEW))
        .when(F.col("__s").isNull(), F.lit(MISSING))
        .when(_changed(track, flat_t, flat_s, null_safe), F.lit(CHANGED))
        .otherwise(F.lit(UNCHANGED))
    )
    return j.select(*keys, klass.alias(CLASS_COL), "t", "s")


def _changed(track, flat_t, flat_s, null_safe) -> Column:
    cond = None
    for c in track:
        t, s = flat_t[c], flat_s[c]
        diff = ~t.eqNullSafe(s) if null_safe else F.coalesce(t != s, F.lit(False))
        cond = diff if cond is None else cond | diff
    return cond if cond is not None else F.lit(False)


def scd2_apply(target: DataFrame, source: DataFrame, keys: Sequence[str], track: Sequence[str],
               effective_date, order_by: Sequence[str | Column] = (),
               null_safe: bool = True) -> DataFrame:
    """Type 2 apply: the whole new dimension (history + current rows).

    * new key (no current row, even if expired rows exist) -> insert current
    * changed tracked column -> expire the current row at ``effective_date``
      and insert the new version from ``effective_date``
    * unchanged, or absent from the source -> row kept as is (no deletes)
    """
    keys = list(keys)
    classified = scd2_classify(target, source, keys, track, order_by, null_safe)
    return emit_changes(target, classified, keys, effective_date)


def emit_changes(target: DataFrame, classified: DataFrame, keys: list[str], effective_date) -> DataFrame:
    """History rows + ONE pass over the classified join emitting, per key, the
    old image (every key with a current row; expired when changed) and/or the
    new image (new and changed keys)."""
    day = F.lit(str(effective_date)).cast("date")
    bookkeeping = (SCD2_START, SCD2_END, SCD2_CURRENT)
    t_type = classified.schema["t"].dataType
    s_type = classified.schema["s"].dataType
    t_fields = {f.name: f.dataType for f in t_type.fields}
    s_fields = {f.name: f.dataType for f in s_type.fields}
    data_cols = [c for c in t_fields if c not in bookkeeping]
    extra_cols = [c for c in s_fields if c not in t_fields and c not in bookkeeping]
    cls = F.col(CLASS_COL)

    old = F.struct(
        *[F.col(f"t.{c}").alias(c) for c in data_cols],
        *[F.lit(None).cast(s_fields[c]).alias(c) for c in extra_cols],
        F.col(f"t.{SCD2_START}").alias(SCD2_START),
        F.when(cls == CHANGED, day).otherwise(F.col(f"t.{SCD2_END}")).alias(SCD2_END),
        F.when(cls == CHANGED, F.lit(False)).otherwise(F.col(f"t.{SCD2_CURRENT}")).alias(SCD2_CURRENT),
    )
    new = F.struct(
        *[(F.col(f"s.{c}").cast(t_fields[c]) if c in s_fields else F.lit(None).cast(t_fields[c])).alias(c)
          for c in data_cols],
        *[F.col(f"s.{c}").alias(c) for c in extra_cols],
        day.alias(SCD2_START),
        F.lit(None).cast("date").alias(SCD2_END),
        F.lit(True).alias(SCD2_CURRENT),
    )
    images = F.filter(
        F.array(F.when(cls != NEW, old), F.when(cls.isin(NEW, CHANGED), new)),
        lambda x: x.isNotNull(),
    )
    out = classified.select(*keys, F.explode(images).alias("__r")).select(*keys, "__r.*")
    history = target.filter(~F.col(SCD2_CURRENT))
    return history.unionByName(out, allowMissingColumns=True)


def scd2_metrics(classified: DataFrame) -> DataFrame:
    """Number of keys per change class."""
    return classified.groupBy(CLASS_COL).agg(F.count(F.lit(1)).alias("keys"))


def scd2_current(dim: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Current rows (pushed down to the scan; pruned when partitioned)."""
    cur = dim.filter(F.col(SCD2_CURRENT))
    return cur.select(*columns) if columns else cur


def scd2_history(snapshots: DataFrame, keys: Sequence[str], track: Sequence[str],
                 snapshot_col: str, order_by: Sequence[str | Column] = (),
                 null_safe: bool = True) -> DataFrame:
    """Whole SCD2 history from a sequence of snapshots in one plan.

    Equal to applying ``scd2_apply`` once per distinct ``snapshot_col`` value,
    in ascending order, with that value as the effective date (and keeping
    only the tracked and data columns of the latest row per key and
    snapshot).  Rows are first reduced to one per (key, snapshot) by a partial
    aggregate, so the window below sees at most one row per key and snapshot,
    whatever the skew of the raw input.
    """
    if not null_safe:
        raise ValueError("scd2_history compares with the previous version; it needs null_safe=True")
    keys = list(keys)
    per_snap = latest_per_key(snapshots, [*keys, snapshot_col], order_by)
    w = Window.partitionBy(*keys).orderBy(snapshot_col)
    changed = None
    for c in track:
        diff = ~F.col(c).eqNullSafe(F.lag(F.col(c)).over(w))
        changed = diff if changed is None else changed | diff
    first = F.row_number().over(w) == 1
    flagged = per_snap.withColumn("__keep", first | changed if changed is not None else first)
    versions = flagged.filter("__keep").drop("__keep")
    nxt = F.lead(F.col(snapshot_col)).over(w)
    return versions.withColumns({
        SCD2_START: F.col(snapshot_col).cast("date"),
        SCD2_END: nxt.cast("date"),
        SCD2_CURRENT: nxt.isNull(),
    }).drop(snapshot_col)

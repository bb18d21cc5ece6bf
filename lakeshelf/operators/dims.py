"""Dimension maintenance: de-duplication, surrogate keys, insert-only
upsert, flag-style type-2 history and the calendar dimension.

All of these are expressed as aggregates and joins that Spark partitions by
key; none of them sorts the whole input in one task.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeshelf.functions.dates import date_attributes
from lakeshelf.session import materialize
from lakeshelf.sources import runs
from lakeshelf.sources.runs import BUCKET, with_bucket

_ROW = "__row"

#: Tables of at most this many rows may be ordered in one task.
SMALL_ROWS = 100_000


def _order_struct(order: Sequence[Column | str]) -> Column:
    return F.struct(*[(F.col(o) if isinstance(o, str) else o).alias(f"o{i}")
                      for i, o in enumerate(order)])


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key: the row with the greatest ``order`` tuple.

    ``max_by`` is partially aggregated, so each map task sends one row per
    key to the shuffle: a hot key costs one row per task, not all its rows in
    one task. (Over a struct, Spark aggregates by sorting each task's rows.) Give ``order`` a unique tail (e.g. the row id)
    so the choice is deterministic."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*[F.col(f"`{c}`") for c in rest]), _order_struct(order))
    return (df.groupBy(*keys).agg(best.alias(_ROW))
              .select(*keys, *[F.col(f"{_ROW}.`{c}`").alias(c) for c in rest])
              .select(*df.columns))


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key: the row with the smallest ``order`` tuple (the
    "keep first" rule, with "first" made explicit)."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*[F.col(f"`{c}`") for c in rest]), _order_struct(order))
    return (df.groupBy(*keys).agg(best.alias(_ROW))
              .select(*keys, *[F.col(f"{_ROW}.`{c}`").alias(c) for c in rest])
              .select(*df.columns))


def dedup_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows over ``cols`` (all columns by default)."""
    return df.select(*(cols or df.columns)).dropDuplicates()


def positions(df: DataFrame, order: Sequence[str], weight: str | None = None, name: str = "__pos",
              partitions: int | None = None, nulls_last: bool = True) -> DataFrame:
    """Add ``name`` = 0-based position of each row in the global ``order``;
    with ``weight``, the sum of the weights of all earlier rows (an exclusive
    running total), without a global single-task window.

    Rows are range-partitioned on ``order`` and sorted inside each partition;
    ``monotonically_increasing_id`` then carries (partition, index). That
    placement is written to the shared scratch folder so a lost executor
    cannot re-sample the ranges and renumber rows. Per-partition totals (one
    row per partition: a proven bound) give each partition its offset; with
    a weight, the running total inside a partition is a window over that
    partition only (range partitions are balanced).

    The input is written first (the range shuffle would compute it twice). If
    the written table has at most SMALL_ROWS rows and no ``partitions`` are
    asked for, one window over them gives the same positions."""
    so = [(F.asc_nulls_last(c) if nulls_last else F.asc_nulls_first(c)) for c in order]
    mid = F.monotonically_increasing_id()
    df = materialize(df, "positions_in")
    if partitions is None and df.count() <= SMALL_ROWS:
        w = Window.orderBy(*so)
        pos = (F.row_number().over(w) - 1 if weight is None else
               F.coalesce(F.sum(weight).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        return df.select(*[F.col(f"`{c}`") for c in df.columns], pos.cast("bigint").alias(name))
    # Without an explicit count the shuffle uses the session's partition
    # count and AQE may merge adjacent (still ordered) ranges.
    ranged = df.repartitionByRange(partitions, *so) if partitions else df.repartitionByRange(*so)
    placed = (ranged.sortWithinPartitions(*so)
                .withColumn("__mid", mid)
                .withColumn("__pid", F.shiftright("__mid", 33))
                .withColumn("__idx", F.col("__mid").bitwiseAND(F.lit((1 << 33) - 1))))
    placed = materialize(placed, "positions")
    w = F.col(weight) if weight else F.lit(1)
    totals = placed.groupBy("__pid").agg(F.sum(w).alias("__n"))
    # ``totals`` has at most ``n`` rows: ordering it in one task is bounded.
    offsets = totals.select("__pid", (F.sum("__n").over(Window.orderBy("__pid")) - F.col("__n")).alias("__off"))
    out = placed.join(F.broadcast(offsets), "__pid")
    if weight is None:
        inner = F.col("__idx")
    else:
        before = Window.partitionBy("__pid").orderBy("__idx").rowsBetween(Window.unboundedPreceding, -1)
        inner = F.coalesce(F.sum(w).over(before), F.lit(0))
    return out.select(*[F.col(f"`{c}`") for c in df.columns],
                      (F.col("__off") + inner).cast("bigint").alias(name))


def with_surrogate_key(df: DataFrame, order: Sequence[str], start: int = 0, name: str = "id",
                       partitions: int | None = None, nulls_last: bool = True) -> DataFrame:
    """Dense ids ``start+1, start+2, ...`` in ``order`` (see :func:`positions`)."""
    p = positions(df, order, name="__pos", partitions=partitions, nulls_last=nulls_last)
    return p.select((F.lit(start) + F.col("__pos") + 1).cast("bigint").alias(name),
                    *[F.col(f"`{c}`") for c in df.columns])


def _key_match(left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool,
               rprefix: str = "") -> Column:
    conds = [(left[k].eqNullSafe(right[rprefix + k]) if null_safe else left[k] == right[rprefix + k])
             for k in keys]
    return reduce(lambda a, b: a & b, conds)


def max_id(dim: DataFrame, sk: str = "id") -> int:
    """Largest surrogate id (0 for an empty dimension). One scalar."""
    v = dim.agg(F.max(sk)).first()[0]
    return int(v) if v is not None else 0


def upsert_dim(dim: DataFrame, delta: DataFrame, keys: Sequence[str], attrs: Sequence[str] = (),
               sk: str = "id", null_safe: bool = False, order: Sequence[Column | str] | None = None,
               only_new: bool = False) -> DataFrame:
    """Insert-only dimension upsert (MERGE ... WHEN NOT MATCHED INSERT).

    The delta is reduced to one row per key (latest by ``order`` if given,
    else the smallest attribute tuple); keys already in ``dim`` are skipped,
    so an attribute that changes later keeps its first value. New rows get
    ids after ``max(dim.sk)``. With ``null_safe=False`` (the SQL default) a
    NULL key never matches, so such a row is inserted again by every run.
    Returns the whole new dimension, or only the inserted rows."""
    keys, attrs = list(keys), list(attrs)
    if order:
        d = dedup_latest(delta, keys, order).select(*keys, *attrs)
    elif attrs:
        d = dedup_first(delta.select(*keys, *attrs), keys, attrs)
    else:
        d = delta.select(*keys).dropDuplicates(keys)
    existing = dim.select(*[F.col(k).alias(f"__d_{k}") for k in keys])
    new = d.join(existing, _key_match(d, existing, keys, null_safe, "__d_"), "left_anti")
    new = with_surrogate_key(new, keys, start=max_id(dim, sk), name=sk)
    new = new.select(*dim.columns)
    return new if only_new else dim.unionByName(new)


def scd2(dim: DataFrame, delta: DataFrame, key: str | Sequence[str], tracked: Sequence[str],
         sk: str = "id", active: str = "is_active", null_safe: bool = False,
         order: Sequence[Column | str] | None = None, id_start: int | None = None) -> DataFrame:
    """Flag-style slowly changing dimension (type 2 without validity dates).

    1. the delta is reduced to one row per key (latest by ``order``);
    2. every active dim row whose tracked attributes differ from the delta's
       is closed (``active`` = 0). Differences are tested with ``<>``, so a
       change to or from NULL is not seen, unless ``null_safe``;
    3. every delta key without an (unchanged) active row gets a new active row
       with a new id.

    One left join of the dimension to the delta decides 2; an anti join of the
    delta to the still-active rows decides 3. The dimension is returned whole
    (untouched + closed + new rows)."""
    keys = [key] if isinstance(key, str) else list(key)
    tracked = list(tracked)
    if order:
        d = dedup_latest(delta, keys, order).select(*keys, *tracked)
    else:
        d = dedup_first(delta.select(*keys, *tracked), keys, tracked)
    r = d.select(*[F.col(c).alias(f"__n_{c}") for c in keys + tracked]).withColumn("__m", F.lit(1))
    j = dim.join(r, (dim[active] == 1) & _key_match(dim, r, keys, null_safe, "__n_"), "left")
    if null_safe:
        diffs = [~dim[c].eqNullSafe(F.col(f"__n_{c}")) for c in tracked]
    else:
        diffs = [F.coalesce(dim[c] != F.col(f"__n_{c}"), F.lit(False)) for c in tracked]
    changed = F.col("__m").isNotNull() & reduce(lambda a, b: a | b, diffs)
    updated = j.select(*[F.when(changed, F.lit(0)).otherwise(dim[active]).cast(dim.schema[active].dataType)
                         .alias(c) if c == active else dim[c] for c in dim.columns])
    updated = materialize(updated, "scd2")
    still = updated.where(F.col(active) == 1).select(*[F.col(k).alias(f"__a_{k}") for k in keys])
    new = d.join(still, _key_match(d, still, keys, null_safe, "__a_"), "left_anti")
    start = max_id(updated, sk) if id_start is None else id_start
    new = with_surrogate_key(new, keys, start=start, name=sk)
    new = new.withColumn(active, F.lit(1).cast(dim.schema[active].dataType))
    return updated.unionByName(new.select(*dim.columns))


# Type-2 history rewritten bucket by bucket ----------------------------------

def scd2_in_place(dim_path: str, delta: DataFrame, key: str | Sequence[str], tracked: Sequence[str],
                  schema: str, buckets: int = 64, sk: str = "id", active: str = "is_active",
                  null_safe: bool = False, order: Sequence[Column | str] | None = None) -> runs.State:
    """:func:`scd2` on a dimension stored at ``dim_path`` in hash buckets of
    the key (:mod:`lakeshelf.sources.runs`): only the buckets that the delta
    touches are read, and their new rows are written as a run beside the old
    one. One new state then shows all of them at once: a crash before it leaves
    the history as it was, and the retry starts from that. A second writer that
    replaced one of the buckets meanwhile makes this one fail, with nothing
    changed. The largest id is kept with the state, so numbering new rows reads
    no other bucket. ``schema`` is the dimension's DDL. Read the dimension with
    :func:`read_dim`."""
    spark = delta.sparkSession
    keys = [key] if isinstance(key, str) else list(key)
    if order:
        d = dedup_latest(delta, keys, order).select(*keys, *tracked)
    else:
        d = dedup_first(delta.select(*keys, *tracked), keys, list(tracked))
    base = runs.newest(spark, dim_path)
    buckets = base.info.get("buckets", buckets)
    d = materialize(with_bucket(d, keys, buckets), "scd2_delta")
    touched = [r[0] for r in d.select(BUCKET).distinct().collect()]  # at most ``buckets`` ints
    if not touched:
        return base
    part = runs.read(spark, dim_path, schema, base, touched)
    start = base.info.get("max_id", 0)
    out = scd2(part, d.drop(BUCKET), keys, tracked, sk=sk, active=active, null_safe=null_safe, id_start=start)
    out = materialize(with_bucket(out, keys, buckets), "scd2_buckets")
    info = {"buckets": buckets, "max_id": max(start, max_id(out, sk))}
    return runs.replace(out, dim_path, base, touched, info)


def read_dim(spark: SparkSession, dim_path: str, schema: str, state: runs.State | None = None) -> DataFrame:
    """A dimension that :func:`scd2_in_place` keeps: as it is now, or at a state."""
    return runs.read(spark, dim_path, schema, state)


# The calendar dimension ------------------------------------------------------

DATE_DIM_DEFAULT_LAST = _dt.date(2022, 12, 31)


def date_dim(spark: SparkSession, start: Column | str | _dt.date, end: Column | str | _dt.date,
             source: DataFrame | None = None) -> DataFrame:
    """One row per day in [start, end]: date_key, date, year, month,
    month_name, quarter, day_of_week (1 = Sunday), is_weekend.

    ``start``/``end`` may be columns of the one-row ``source`` (e.g. the
    min/max of a fact's dates), so the bounds never visit the driver. The
    row count is the calendar span, independent of the data volume."""
    def as_col(v):
        if isinstance(v, Column):
            return v
        if isinstance(v, _dt.date):
            return F.lit(v)
        return F.to_date(F.lit(v))
    base = source if source is not None else spark.range(1)
    days = base.select(F.explode(F.sequence(as_col(start).cast("date"), as_col(end).cast("date"),
                                            F.expr("interval 1 day"))).alias("date"))
    return days.select(*date_attributes("date"))


def extend_date_dim(dim: DataFrame, today: _dt.date) -> DataFrame:
    """Rows to append so the calendar reaches ``today``.

    Next day = (max(date) or 2022-12-31) + 1; rows are added only when that
    day is before ``today`` and then run through ``today`` inclusive (so a
    calendar ending yesterday gets nothing, one ending two days ago gets
    two days)."""
    spark = dim.sparkSession
    nxt = dim.agg(F.date_add(F.coalesce(F.max("date"), F.lit(DATE_DIM_DEFAULT_LAST)), 1).alias("s"))
    nxt = nxt.where(F.col("s") < F.lit(today))
    return date_dim(spark, F.col("s"), F.lit(today), source=nxt)

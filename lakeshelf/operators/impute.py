"""Group-wise imputation: per-group mode and median lookups joined back once.

Plan shape (whatever the number of imputed columns):

* the columns of which a mode is asked are unpivoted to (group, column, value),
  typed, and counted with map-side partial aggregation (:func:`count_table`).
  The shuffle key holds the value, so a hot group is spread over many tasks, and
  the counts are additive: they can be stored per load and summed over the history;
* mode: the most frequent value per (group, column) with ``min_by`` over the
  counts, ties to the smallest value;
* median: exact by selection (:mod:`lakeshelf.operators.selection`), which
  never gathers a group in one task and writes no values. ``exact=False`` is
  the explicit approximate form (``percentile_approx``), whose answer drifts
  once groups are large;
* the lookups (one row per group) are joined to the input in ONE left join,
  broadcast only when their measured size is under the threshold, otherwise
  a shuffle join that AQE can split for skewed groups.
"""

from __future__ import annotations

from typing import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshelf.operators import selection
from lakeshelf.session import checked_broadcast, materialize

_G = "__grp"


def value_counts(df: DataFrame, group: str, column: str, name: str = "freq") -> DataFrame:
    """Frequency of each non-NULL (group, value)."""
    return (df.where(F.col(column).isNotNull())
              .groupBy(group, column).agg(F.count(F.lit(1)).alias(name)))


def _pick_mode(value: Column, freq: Column) -> Column:
    # Most frequent; ties go to the smallest value (a total order, so the
    # result does not depend on partitioning). A NULL freq gives a NULL
    # ordering, which min_by ignores.
    return F.min_by(value, F.when(freq.isNotNull(), F.struct((-freq).alias("f"), value.alias("v"))))


#: Where a column's values are kept in a count table, by type.
VALUE_COLUMNS = ("__int", "__num", "__str")
_FLOATS = (T.DoubleType(), T.FloatType())
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _place(t: T.DataType) -> str:
    return "__int" if isinstance(t, _WHOLE) else "__num" if t in _FLOATS else "__str"


def count_table(df: DataFrame, group: str, cols: Iterable[str]) -> DataFrame:
    """(__grp, __col, __int, __num, __str, __n): how often each value of each
    column occurs in each group. Whole numbers and floats keep their type (other
    values are text), so nothing is formatted or parsed on the way; NULL and NaN
    are missing and not counted. Tables of disjoint rows add up."""
    kinds = {"__int": "bigint", "__num": "double", "__str": "string"}
    cells = []
    for c in cols:
        place = _place(df.schema[c].dataType)
        v = F.when(~F.isnan(c), F.col(c)) if place == "__num" else F.col(c)
        cells.append(F.struct(F.lit(c).alias("__col"), *[(v if k == place else F.lit(None)).cast(t).alias(k) for k, t in kinds.items()]))
    long = df.select(F.col(group).alias(_G), F.explode(F.array(*cells)).alias("x")).select(_G, "x.*")
    long = long.where(F.col("__int").isNotNull() | F.col("__num").isNotNull() | F.col("__str").isNotNull())
    return long.groupBy(_G, "__col", *kinds).agg(F.count(F.lit(1)).alias("__n"))


def _value(t: T.DataType) -> Column:
    place = _place(t)
    return F.col(place).try_cast(t) if place == "__str" else F.col(place).cast(t)


def lookups_from_counts(counts: DataFrame, modes: Mapping[str, T.DataType],
                        medians: Mapping[str, T.DataType], summed: bool = False) -> DataFrame:
    """One row per group with ``mode_<c>`` and ``median_<c>`` from count
    tables (several of them are summed, unless they already are)."""
    modes, medians = dict(modes), dict(medians)
    total = counts if summed else counts.groupBy(_G, "__col", *VALUE_COLUMNS).agg(F.sum("__n").alias("__n"))
    out = None
    if modes:
        picks = []
        for c, t in modes.items():
            v = F.when(F.col("__col") == c, _value(t))
            picks.append(_pick_mode(v, F.when(v.isNotNull(), F.col("__n"))).alias(f"mode_{c}"))
        out = total.where(F.col("__col").isin(*modes)).groupBy(_G).agg(*picks)
    for c, t in medians.items():
        pairs = total.where(F.col("__col") == c).select(_G, _value(t).alias("__v"), F.col("__n").alias("__c"))
        out = side_by_side(out, weighted_median(pairs, interpolate=False, name=f"median_{c}"))
    return out


def side_by_side(a: DataFrame | None, b: DataFrame) -> DataFrame:
    """Lookups of the same groups in one table."""
    if a is None:
        return b
    return a.join(b, a[_G].eqNullSafe(b[_G]), "full").select(
        F.coalesce(a[_G], b[_G]).alias(_G), *[a[x] for x in a.columns if x != _G], *[b[x] for x in b.columns if x != _G])


def group_lookups(df: DataFrame, group: str, modes: Iterable[str] = (),
                  medians: Iterable[str] = (), exact: bool = True) -> DataFrame:
    """All lookups keyed by ``__grp``, columns ``mode_<c>`` / ``median_<c>``,
    from one count of the input. With ``exact=False`` the medians are
    ``percentile_approx`` sketches instead."""
    modes, medians = list(modes), list(medians)
    types = {c: df.schema[c].dataType for c in modes + medians}
    if exact or not medians:
        out = None
        if modes:
            out = lookups_from_counts(count_table(df, group, modes), {c: types[c] for c in modes}, {}, summed=True)
        for c in medians:
            m = exact_median(df, group, c, interpolate=False, name=f"median_{c}").withColumnRenamed(group, _G)
            out = side_by_side(out, m)
        return out
    approx = df.groupBy(F.col(group).alias(_G)).agg(
        *[F.percentile_approx(c, 0.5, 10000).alias(f"median_{c}") for c in medians])
    if not modes:
        return approx
    m = lookups_from_counts(count_table(df, group, modes), {c: types[c] for c in modes}, {})
    return approx.join(m, approx[_G].eqNullSafe(m[_G]), "left").drop(m[_G])


def impute(df: DataFrame, group: str, modes: Mapping[str, object] | None = None,
           medians: Mapping[str, object] | None = None, exact: bool = True,
           overwrite: bool = False, lookups: DataFrame | None = None) -> DataFrame:
    """Fill missing values from per-group lookups in one pass.

    ``modes`` / ``medians`` map column -> default used when the row's group has
    no lookup value (including a NULL group, which never matches).
    Each column becomes ``coalesce(own, lookup, default)``; with
    ``overwrite=True`` a present lookup replaces even a present value
    (``coalesce(lookup, default)``). All lookups are computed from the same
    input, so the order of the columns does not matter."""
    modes, medians = dict(modes or {}), dict(medians or {})
    if not modes and not medians:
        return df
    lk = lookups if lookups is not None else group_lookups(df, group, modes, medians, exact)
    lk = checked_broadcast(lk)
    joined = df.join(lk, df[group] == lk[_G], "left")
    repl = {}
    for kind, spec in (("mode", modes), ("median", medians)):
        for c, default in spec.items():
            dtype = df.schema[c].dataType
            look = F.col(f"{kind}_{c}").cast(dtype)
            dflt = F.lit(default).cast(dtype)
            repl[c] = F.coalesce(look, dflt) if overwrite else F.coalesce(F.col(c), look, dflt)
    out_cols = [repl[c].alias(c) if c in repl else df[c] for c in df.columns]
    return joined.select(*out_cols)


def impute_mode(df: DataFrame, group: str, cols: Iterable[str], default: object = 1,
                overwrite: bool = False) -> DataFrame:
    """coalesce(own, mode within group, default) for each column."""
    return impute(df, group, modes={c: default for c in cols}, overwrite=overwrite)


def impute_median(df: DataFrame, group: str, col: str, default: object = 500,
                  exact: bool = True) -> DataFrame:
    """coalesce(own, median within group, default)."""
    return impute(df, group, medians={col: default}, exact=exact)


def mode_by_group(df: DataFrame, group: str, col: str) -> DataFrame:
    """(group, mode) for each group with any non-NULL value."""
    counts = value_counts(df, group, col, "__n")
    return counts.groupBy(group).agg(_pick_mode(F.col(col), F.col("__n")).alias(f"mode_{col}"))


def median_by_group(df: DataFrame, group: str, col: str, exact: bool = True) -> DataFrame:
    """(group, median) of every group, NULL where it has no value."""
    if exact:
        m = exact_median(df, group, col, interpolate=False, name=f"median_{col}").withColumnRenamed(group, _G)
        keys = df.select(F.col(group).alias(_G)).distinct()
        m = keys.join(m, keys[_G].eqNullSafe(m[_G]), "left").drop(m[_G])
    else:
        m = df.groupBy(F.col(group).alias(_G)).agg(F.percentile_approx(col, 0.5, 10000).alias(f"median_{col}"))
    return m.withColumnRenamed(_G, group)


def exact_median(df: DataFrame, group: str | None, col: str, interpolate: bool = True,
                 name: str | None = None) -> DataFrame:
    """Exact per-group median that never gathers a group, or a repeated
    value, in one task: numbers by :mod:`lakeshelf.operators.selection` (bin
    counts, then the values of the middle bins only), other values by
    :func:`weighted_median` over counted values.

    ``interpolate`` averages the two middle values (pandas ``median``,
    ``quantile_cont``); otherwise the lower one (``percentile_disc(0.5)``).
    NULL and NaN are ignored; a group with no values is absent."""
    name = name or f"median_{col}"
    g = F.col(group) if group else F.lit(0)
    v = F.when(~F.isnan(col), F.col(col)) if df.schema[col].dataType in _FLOATS else F.col(col)
    rows = df.select(g.alias(_G), v.alias("__v")).where(F.col("__v").isNotNull())
    if isinstance(df.schema[col].dataType, selection.NUMERIC):
        out = selection.median(rows.withColumn("__c", F.lit(1).cast("bigint")), interpolate, name)
    else:
        out = weighted_median(rows.groupBy(_G, "__v").agg(F.count(F.lit(1)).alias("__c")), interpolate, name)
    return out.withColumnRenamed(_G, group) if group else out.drop(_G)


def weighted_median(pairs: DataFrame, interpolate: bool, name: str) -> DataFrame:
    """(__grp, median) from distinct (__grp, __v) pairs with counts __c.
    Numbers go by selection. Of others, at most SMALL_ROWS pairs are ordered by
    a window, more by :func:`positions`."""
    from lakeshelf.operators.dims import SMALL_ROWS, positions
    if isinstance(pairs.schema["__v"].dataType, selection.NUMERIC):
        return selection.median(materialize(pairs, "pairs"), interpolate, name)
    pairs = materialize(pairs, "pairs")
    if pairs.count() <= SMALL_ROWS:
        group = Window.partitionBy(_G)
        upto = F.sum("__c").over(group.orderBy("__v").rowsBetween(Window.unboundedPreceding, 0))
        x = pairs.select(_G, "__v", "__c", upto.alias("__u"), F.sum("__c").over(group).alias("__n"))
        # ranks [u - c, u) are this value's; the middle ranks are (n - 1) / 2, down and up
        hit = lambda r: (F.col("__u") - F.col("__c") <= r) & (r < F.col("__u"))
        lo, hi = F.floor((F.col("__n") - 1) / 2), F.ceil((F.col("__n") - 1) / 2)
        lo_v, hi_v = F.max(F.when(hit(lo), F.col("__v"))), F.max(F.when(hit(hi), F.col("__v")))
        return x.groupBy(_G).agg((((lo_v + hi_v) / 2) if interpolate else lo_v).alias(name))
    pos = positions(pairs, [_G, "__v"], weight="__c", name="__p")
    stats = pos.groupBy(_G).agg(F.min("__p").alias("__s"), F.sum("__c").alias("__n"))
    stats = stats.select(F.col(_G).alias("__g2"),
                         (F.col("__s") + F.floor((F.col("__n") - 1) / 2)).cast("bigint").alias("__lo"),
                         (F.col("__s") + F.ceil((F.col("__n") - 1) / 2)).cast("bigint").alias("__hi"))
    hit = lambda r: (F.col("__p") <= r) & (r < F.col("__p") + F.col("__c"))
    j = pos.join(checked_broadcast(stats), pos[_G].eqNullSafe(F.col("__g2")))
    j = j.where(hit(F.col("__lo")) | hit(F.col("__hi")))
    lo_v = F.max(F.when(hit(F.col("__lo")), F.col("__v")))
    hi_v = F.max(F.when(hit(F.col("__hi")), F.col("__v")))
    val = ((lo_v + hi_v) / 2) if interpolate else lo_v
    return j.groupBy(_G).agg(val.alias(name))

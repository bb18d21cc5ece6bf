"""Exact medians by selection instead of sorting: count values into the bins of
a fixed grid, keep the bin that holds the middle rank, look only at its values.

The grid is logarithmic (a bin spans about 1 % of its value), monotone and the
same for every table, so bin counts of different loads add up and can be stored
beside the values (:mod:`lakeshelf.plans.silver`). Counting is a map-side
partial aggregation with one row per (group, bin); the middle bins hold about a
hundredth of a group's distinct values. Where that is still many, the bin is
divided again, linearly, until few are left (at most five times, as a double
has 52 bits). No group is gathered or sorted as a whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshelf.session import checked_broadcast, materialize

GROUP = "__grp"
#: Bins of the grid for each factor e, and the number of the bin of 1.0.
PER_E, ONE = 92.0, 100_000
#: A middle bin of at most this many distinct values is ordered by a window.
FEW = 100_000
#: Parts of a bin that is divided again.
PARTS = 4096

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def grid_bin(v: Column) -> Column:
    """The grid's bin of a number (not NaN), never falling as it grows."""
    x = v.cast("double")
    size = F.floor(F.least(F.greatest(F.log(F.abs(x)) * PER_E, F.lit(1.0 - ONE)), F.lit(ONE - 1.0))).cast("int") + ONE
    return F.when(x == 0, F.lit(0)).when(x > 0, size).otherwise(-size)


def histogram(rows: DataFrame, by: tuple = (GROUP,), value: str = "__v", weight: str = "__c") -> DataFrame:
    """(by ..., __bin, __n): how much weight falls into each bin."""
    return rows.groupBy(*by, grid_bin(F.col(value)).alias("__bin")).agg(F.sum(weight).alias("__n"))


def middle_bins(hist: DataFrame) -> DataFrame:
    """(group, __which, __bin, __rank, __start, __n): the bin of each group's
    lower middle rank (which 0) and, if the total is even, of the upper one (which
    1); __start is the rank of the bin's first value."""
    group = Window.partitionBy(GROUP)
    upto = F.sum("__n").over(group.orderBy("__bin").rowsBetween(Window.unboundedPreceding, 0))
    x = hist.select(GROUP, "__bin", "__n", (upto - F.col("__n")).alias("__start"), F.sum("__n").over(group).alias("__total"))
    half = F.expr("(__total - 1) div 2")
    ranks = F.when(F.col("__total") % 2 == 0, F.array(F.struct(F.lit(0).alias("w"), half.alias("r")), F.struct(F.lit(1).alias("w"), (half + 1).alias("r"))))
    x = x.withColumn("__q", F.explode(ranks.otherwise(F.array(F.struct(F.lit(0).alias("w"), half.alias("r"))))))
    x = x.where((F.col("__start") <= F.col("__q.r")) & (F.col("__q.r") < F.col("__start") + F.col("__n")))
    return x.select(GROUP, F.col("__q.w").alias("__which"), "__bin", F.col("__q.r").alias("__rank"), "__start", "__n")


def pick(chosen: DataFrame, rows: DataFrame, interpolate: bool, name: str) -> DataFrame:
    """(group, median) from stored :func:`middle_bins` and rows (group, __v,
    __c), of which only those in the middle bins count."""
    c = chosen.select(F.col(GROUP).alias("__g2"), "__which", "__bin", "__rank", "__start")
    near = rows.withColumn("__b2", grid_bin(F.col("__v"))).join(
        checked_broadcast(c, stored=True), F.col(GROUP).eqNullSafe(F.col("__g2")) & (F.col("__b2") == F.col("__bin")))
    key = [GROUP, "__which"]
    sub = near.groupBy(*key, "__v").agg(F.sum("__c").alias("__c"), F.first("__rank").alias("__rank"), F.first("__start").alias("__start"))
    if (chosen.agg(F.max("__n")).first()[0] or 0) > FEW:
        sub = _divided(materialize(sub, "middle"))
    each = Window.partitionBy(*key)
    upto = F.col("__start") + F.sum("__c").over(each.orderBy("__v").rowsBetween(Window.unboundedPreceding, 0))
    hit = sub.withColumn("__u", upto).where((F.col("__u") - F.col("__c") <= F.col("__rank")) & (F.col("__rank") < F.col("__u")))
    low, high = (F.max(F.when(F.col("__which") == w, F.col("__v"))) for w in (0, 1))
    return hit.groupBy(GROUP).agg((((low + F.coalesce(high, low)) / 2) if interpolate else low).alias(name))


def _divided(sub: DataFrame) -> DataFrame:
    """Distinct values of the middle bins, cut down to parts of at most FEW."""
    key = [GROUP, "__which"]
    x = F.col("__v").cast("double")
    while True:
        spans = sub.groupBy(*key).agg(F.count(F.lit(1)).alias("__d"), F.min(x).alias("__lo"), F.max(x).alias("__hi"))
        spans = materialize(spans, "spans")
        wide = spans.where((F.col("__d") > FEW) & (F.col("__lo") < F.col("__hi")))
        if wide.isEmpty():
            return sub
        s = checked_broadcast(spans.select(F.col(GROUP).alias("__g2"), F.col("__which").alias("__w2"), "__d", "__lo", "__hi"), stored=True)
        part = F.when((F.col("__d") > FEW) & (F.col("__lo") < F.col("__hi")),
                      F.least(F.floor((x - F.col("__lo")) / (F.col("__hi") - F.col("__lo")) * PARTS), F.lit(PARTS - 1))).otherwise(0)
        same = F.col(GROUP).eqNullSafe(F.col("__g2")) & (F.col("__which") == F.col("__w2"))
        cut = materialize(sub.join(s, same).select(*sub.columns, part.cast("int").alias("__part")), "parts")
        sizes = cut.groupBy(*key, "__part").agg(F.sum("__c").alias("__n"), F.first("__rank").alias("__rank"), F.first("__start").alias("__start"))
        upto = F.col("__start") + F.sum("__n").over(Window.partitionBy(*key).orderBy("__part").rowsBetween(Window.unboundedPreceding, 0))
        at = sizes.withColumn("__u", upto).where((F.col("__u") - F.col("__n") <= F.col("__rank")) & (F.col("__rank") < F.col("__u")))
        at = materialize(at.select(F.col(GROUP).alias("__g2"), F.col("__which").alias("__w2"), F.col("__part").alias("__p2"),
                                   (F.col("__u") - F.col("__n")).alias("__s2")), "chosen_parts")
        sub = cut.join(checked_broadcast(at, stored=True), same & (F.col("__part") == F.col("__p2")))
        sub = materialize(sub.select(*key, "__v", "__c", "__rank", F.col("__s2").alias("__start")), "middle")


def median(rows: DataFrame, interpolate: bool, name: str) -> DataFrame:
    """(group, median) of rows (group, __v, __c) with numeric values, which
    may repeat. The rows are read twice and never written."""
    chosen = materialize(middle_bins(histogram(rows)), "middle_bins")
    return pick(chosen, rows, interpolate, name)

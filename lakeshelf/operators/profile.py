"""Data profiling: frequencies, NULL/NaN counts, distinct values, extremes,
grouped averages. Each profile is one aggregate plan (partial aggregation on
the map side), never a loop of actions on the driver."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMERIC_FLOAT = (T.DoubleType, T.FloatType)


def value_freq(df: DataFrame, cols: Iterable[str], name: str = "freq",
               order_by_freq: bool = True) -> DataFrame:
    """Row count per combination of ``cols`` (NULL is a value of its own),
    most frequent first, then by the columns."""
    cols = list(cols)
    out = df.groupBy(*cols).agg(F.count(F.lit(1)).alias(name))
    if order_by_freq:
        out = out.orderBy(F.desc(name), *[F.asc_nulls_last(c) for c in cols])
    return out


def missing_counts(df: DataFrame, nan_is_missing: bool = False) -> DataFrame:
    """One row: for every column the number of NULLs (and NaNs in floating
    columns when ``nan_is_missing``). One pass over the data."""
    aggs = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        miss = c.isNull()
        if nan_is_missing and isinstance(f.dataType, _NUMERIC_FLOAT):
            miss = miss | F.isnan(c)
        aggs.append(F.count_if(miss).alias(f.name))
    return df.agg(*aggs)


def null_profile(df: DataFrame, only_missing: bool = True, nan_is_missing: bool = False) -> DataFrame:
    """Long form (column_name, null_count) of :func:`missing_counts`; with
    ``only_missing`` just the columns that have any."""
    wide = missing_counts(df, nan_is_missing)
    long = wide.unpivot([], wide.columns, "column_name", "null_count")
    if only_missing:
        long = long.where(F.col("null_count") > 0)
    return long


def nan_null_counts(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """(column_name, nan_count, null_count) for floating columns: NaN and NULL
    are different markers in Spark (isnan(NULL) is false)."""
    cols = list(cols)
    aggs = []
    for c in cols:
        aggs += [F.count_if(F.isnan(c)).alias(f"{c}__nan"), F.count_if(F.col(c).isNull()).alias(f"{c}__null")]
    wide = df.agg(*aggs)
    stack = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"{c}__nan").alias("nan_count"),
                 F.col(f"{c}__null").alias("null_count")) for c in cols]))
    return wide.select(stack.alias("s")).select("s.*")


def distinct_values(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    cols = list(cols)
    return df.select(*cols).distinct()


def filtered_count(df: DataFrame, preds: dict[str, Column]) -> DataFrame:
    """One row with ``count_if`` of each named predicate plus the total."""
    return df.agg(F.count(F.lit(1)).alias("total"),
                  *[F.count_if(p).alias(n) for n, p in preds.items()])


def min_max(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    return df.agg(*aggs)


def avg_by_group(df: DataFrame, group: str | list[str], col: str, digits: int = 2,
                 name: str | None = None) -> DataFrame:
    groups = [group] if isinstance(group, str) else list(group)
    name = name or f"avg_{col}"
    return (df.groupBy(*groups).agg(F.round(F.avg(col), digits).alias(name))
              .orderBy(*[F.asc_nulls_last(g) for g in groups]))


def group_having(df: DataFrame, group: str | list[str], min_count: int,
                 name: str = "n") -> DataFrame:
    """Groups with more than ``min_count`` rows (GROUP BY ... HAVING)."""
    groups = [group] if isinstance(group, str) else list(group)
    return (df.groupBy(*groups).agg(F.count(F.lit(1)).alias(name))
              .where(F.col(name) > min_count))


def profile(df: DataFrame, group: str | None = None, measure: str | None = None) -> dict[str, DataFrame]:
    """The exploration bundle: schema is ``df.schema``; the rest are lazy
    DataFrames the caller may show or write."""
    out = {"nulls": null_profile(df, nan_is_missing=True)}
    if group:
        out["freq"] = value_freq(df, [group])
        out["distinct"] = distinct_values(df, [group])
    if measure:
        out["min_max"] = min_max(df, [measure])
        if group:
            out["avg"] = avg_by_group(df, group, measure)
    return out

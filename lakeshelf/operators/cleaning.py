"""Row-wise cleaning operators (projection, tolerant casts, fills, decodes,
flags, trimming, NaN handling). Each is one ``select``/``withColumns`` so a
chain of them stays a single codegen stage with no shuffle."""

from __future__ import annotations

from typing import Any, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshelf.functions.predicates import decode as decode_col
from lakeshelf.functions.predicates import flag_text


def _ref(name: str) -> Column:
    """Column reference that tolerates dots in flat names (``user.name``)."""
    return F.col(f"`{name}`") if "." in name and not name.startswith("`") else F.col(name)


def project(df: DataFrame, spec: Mapping[str, str | Column]) -> DataFrame:
    """Select and rename: ``spec`` maps output name -> source name or Column.
    Source names may contain dots (flattened JSON keys)."""
    cols = [(_ref(src) if isinstance(src, str) else src).alias(out) for out, src in spec.items()]
    return df.select(*cols)


def try_cast_col(c: str | Column, dtype: str | T.DataType) -> Column:
    col = _ref(c) if isinstance(c, str) else c
    return col.try_cast(dtype)


def typed(df: DataFrame, types: Mapping[str, str | T.DataType], strict: bool = False) -> DataFrame:
    """Cast the named columns in place. Tolerant by default: text that does
    not parse becomes NULL (``try_cast``) instead of failing the job under
    ANSI mode. ``strict=True`` uses ``cast`` and fails on bad input."""
    repl = {}
    for name, t in types.items():
        c = _ref(name)
        repl[name] = c.cast(t) if strict else c.try_cast(t)
    return df.withColumns(repl)


def cast_rejects(df: DataFrame, types: Mapping[str, str | T.DataType]) -> DataFrame:
    """One row with, per column, how many non-NULL inputs failed the cast."""
    aggs = [F.count_if(_ref(n).isNotNull() & _ref(n).try_cast(t).isNull()).alias(f"{n}_rejects")
            for n, t in types.items()]
    return df.agg(*aggs)


def fill_const(df: DataFrame, values: Mapping[str, Any]) -> DataFrame:
    """Replace NULLs per column with a constant."""
    return df.fillna(dict(values))


def fill_strings(df: DataFrame, value: str = "N/A") -> DataFrame:
    """Replace NULLs in every string column; other columns are untouched."""
    return df.fillna(value)


def decode(df: DataFrame, column: str, mapping: Mapping[Any, Any], default: Any = None,
           output: str | None = None) -> DataFrame:
    """Replace a code column by its label (see ``functions.decode``)."""
    return df.withColumn(output or column, decode_col(column, mapping, default))


def flags_to_text(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    """For each ``old -> new``: new = Yes/No for 1/0, NULL otherwise; drop old.
    One projection for all flags."""
    out = []
    for f in df.columns:
        if f in renames:
            out.append(flag_text(f).alias(renames[f]))
        else:
            out.append(F.col(f"`{f}`"))
    return df.select(*out)


def trim_strings(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Strip leading and trailing white space, in its Unicode sense (spaces,
    tabs, line breaks, no-break and wide spaces)."""
    return df.withColumns({c: F.regexp_replace(_ref(c), r"(?U)^\s+|\s+$", "") for c in cols})


def nan_to_null(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Turn NaN into NULL in floating columns so that NULL is the only
    missing marker downstream (Spark sorts NaN above every number)."""
    floating = {f.name for f in df.schema.fields
                if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    targets = [c for c in (cols or floating) if c in floating]
    return df.withColumns({c: F.when(F.isnan(_ref(c)), F.lit(None)).otherwise(_ref(c))
                           for c in targets})


def drop_all_missing(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop rows where every listed column is missing (NULL or NaN)."""
    return nan_to_null(df, cols).na.drop(how="all", subset=list(cols))


def conform(df: DataFrame, schema: T.StructType, rename: Mapping[str, str] | None = None) -> DataFrame:
    """Project onto a fixed schema: pick (and optionally rename) the columns in
    schema order, tolerant-cast each to its declared type; absent columns
    become typed NULLs."""
    rename = dict(rename or {})
    have = set(df.columns)
    cols = []
    for f in schema.fields:
        src = rename.get(f.name, f.name)
        if src in have:
            c = _ref(src)
            cols.append((c if df.schema[src].dataType == f.dataType else c.try_cast(f.dataType)).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)

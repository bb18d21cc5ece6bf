"""Rejected values kept: a typed projection that carries, in the same pass,
the raw cells that did not parse, and a versioned write of both.

A cell is rejected if its text is there but does not parse as the column's
type (blank text included)."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshelf.operators.cleaning import _ref, try_cast_col
from lakeshelf.session import materialize, scratch_scope
from lakeshelf.sources.io import VERSION, append_version

REJECTS = "__rejects"
CELL = "array<struct<column: string, type: string, value: string>>"


def _bad(source: str, dtype: str) -> Column:
    return _ref(source).isNotNull() & try_cast_col(source, dtype).isNull()


def typed_with_rejects(df: DataFrame, fields: Mapping[str, tuple[str, str]], keep: Sequence[str] = ()) -> DataFrame:
    """``fields`` maps raw name -> (output name, type), casts are tolerant; the
    raw columns in ``keep`` stay. ``__rejects`` holds (column, type, value) of
    the cells that did not parse, in field order; it is NULL if none."""
    cells = [F.when(_bad(s, t), F.struct(F.lit(s).alias("column"), F.lit(t).alias("type"), _ref(s).cast("string").alias("value")))
             for s, (_, t) in fields.items()]
    bad = F.array_compact(F.array(*cells)).cast(CELL)
    return df.select(*[try_cast_col(s, t).alias(o) for s, (o, t) in fields.items()], *[_ref(c).alias(f"__raw_{c}") for c in keep],
                     F.when(F.size(bad) > 0, bad).alias(REJECTS))


def measured(df: DataFrame, fields: Mapping[str, tuple[str, str]], observation: Observation) -> DataFrame:
    """``df`` (of :func:`typed_with_rejects`) with the rejects of each column
    counted while it is written, under the raw column's name, beside ``rows``."""
    names = F.transform(F.coalesce(F.col(REJECTS), F.expr(f"CAST(array() AS {CELL})")), lambda x: x["column"])
    counts = [F.count_if(F.array_contains(names, s)).alias(s) for s in fields]
    return df.observe(observation, F.count(F.lit(1)).alias("rows"), *counts)


def write_with_quarantine(raw: DataFrame, fields: Mapping[str, tuple[str, str]], key: str, table: str, quarantine: str,
                          version: int, finish=None) -> dict[str, int]:
    """Write a version of ``table`` (typed rows, through ``finish`` if given)
    and the same version of ``quarantine`` ((key, column, type, value), a row
    for each rejected cell), and return the counts. ``raw`` is scanned once. A
    retry of the version replaces both; a version without rejects
    leaves no rows of an earlier try."""
    spark = raw.sparkSession
    seen = Observation()
    with scratch_scope(spark):
        kept = materialize(measured(typed_with_rejects(raw, fields, [key]), fields, seen), "typed")
        cells = kept.where(F.col(REJECTS).isNotNull()).select(
            F.col(f"__raw_{key}").cast("string").alias("key"), F.explode(REJECTS).alias("c")).select("key", "c.*")
        # written plainly: an overwrite by partition would keep what an earlier try left if there are no rows now
        cells.write.mode("overwrite").parquet(f"{quarantine.rstrip('/')}/{VERSION}={int(version)}")
        typed = kept.drop(f"__raw_{key}", REJECTS)
        append_version(finish(typed) if finish else typed, table, version)
    return {k: int(v) for k, v in seen.get.items()}


QUARANTINE_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("key", "column", "type", "value")]
                                 + [T.StructField(VERSION, T.IntegerType())])


def read_quarantine(spark, path: str) -> DataFrame:
    return spark.read.schema(QUARANTINE_SCHEMA).parquet(path)

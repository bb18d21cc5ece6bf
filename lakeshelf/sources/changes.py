"""Row-level change feeds: what was inserted, changed (row before and after)
and deleted between two states of a keyed table, and how to consume it.

A feed is an ordinary versioned table (:mod:`lakeshelf.sources.io`) whose rows
carry ``_change_type``: ``insert``, ``update_preimage``, ``update_postimage`` or
``delete``. ``io.read_changes`` reads a range of versions; :func:`net` reduces
it to at most one change for each key, so a row that was updated ten times is
applied once, and one that came and went not at all."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshelf.sources.io import VERSION

CHANGE = "_change_type"
INSERT, BEFORE, AFTER, DELETE = "insert", "update_preimage", "update_postimage", "delete"


def _same(a: str, b: str, n: int) -> Column:
    return reduce(lambda x, y: x & y, [F.col(f"{a}{i}").eqNullSafe(F.col(f"{b}{i}")) for i in range(n)])


def _from_images(pairs: DataFrame, columns: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """Change rows of (__old, __new) images; equal images (NULL equals NULL)
    are no change."""
    image = lambda kind, c: F.struct(F.lit(kind).alias(CHANGE), F.col(c).alias("row"))
    kinds = (F.when(F.col("__old").isNull() & F.col("__new").isNull(), F.array())
             .when(F.col("__old").isNull(), F.array(image(INSERT, "__new")))
             .when(F.col("__new").isNull(), F.array(image(DELETE, "__old")))
             .when(F.col("__old").eqNullSafe(F.col("__new")), F.array())
             .otherwise(F.array(image(BEFORE, "__old"), image(AFTER, "__new"))))
    rows = pairs.select(*extra, F.explode(kinds).alias("__c"))
    return rows.select(F.col(f"__c.{CHANGE}").alias(CHANGE), *[F.col(f"__c.row.`{c}`").alias(c) for c in columns], *extra)


def row_changes(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The changes that turn ``old`` into ``new`` (same columns, keys unique in
    each, a NULL key equal to NULL): one full outer comparison, partitioned by
    the keys, that reads each state once."""
    columns, n = old.columns, len(keys)

    def side(df, p):
        return df.select(*[F.col(f"`{k}`").alias(f"{p}{i}") for i, k in enumerate(keys)], F.struct(*[F.col(f"`{c}`") for c in columns]).alias("__old" if p == "__a" else "__new"))

    return _from_images(side(old, "__a").join(side(new, "__b"), _same("__a", "__b", n), "full_outer"), columns)


def net(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A feed's range reduced to at most one insert, update pair or delete for
    each key: the row before its first version against the row after its last.
    Partially aggregated, so a hot key costs a row per task."""
    columns = [c for c in changes.columns if c not in (CHANGE, VERSION)]
    row, kind = F.struct(*[F.col(f"`{c}`") for c in columns]), F.col(CHANGE)
    # within a version a key has one change, whose rows are told apart by kind
    first = F.min_by(F.struct(kind.isin(BEFORE, DELETE).alias("had"), row.alias("row")), F.struct(F.col(VERSION), kind.isin(AFTER, INSERT)))
    last = F.max_by(F.struct(kind.isin(AFTER, INSERT).alias("has"), row.alias("row")), F.struct(F.col(VERSION), kind.isin(AFTER, INSERT)))
    pairs = changes.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(first.alias("__f"), last.alias("__l"))
    pairs = pairs.select(F.when(F.col("__f.had"), F.col("__f.row")).alias("__old"), F.when(F.col("__l.has"), F.col("__l.row")).alias("__new"))
    return _from_images(pairs, columns)


def apply(target: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``target`` after the net ``changes``: changed and deleted keys leave,
    new images come. Applying the same changes twice gives the same table."""
    n = len(keys)
    gone = changes.select(*[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)]).distinct()
    t = target.select("*", *[F.col(f"`{k}`").alias(f"__t{i}") for i, k in enumerate(keys)])
    kept = t.join(gone, _same("__t", "__k", n), "left_anti").drop(*[f"__t{i}" for i in range(n)])
    return kept.unionByName(upserts(changes).select(*[F.col(f"`{c}`") for c in target.columns]))


def upserts(changes: DataFrame) -> DataFrame:
    """New images only: the delta for dimensions, which keep what was deleted."""
    return changes.where(F.col(CHANGE).isin(INSERT, AFTER)).drop(CHANGE)


def signed(changes: DataFrame, name: str = "__sign") -> DataFrame:
    """Change rows with +1 for images that come and -1 for images that go: a
    stored sum or count takes sum(sign * value), each update once."""
    return changes.withColumn(name, F.when(F.col(CHANGE).isin(INSERT, AFTER), F.lit(1)).otherwise(F.lit(-1)))

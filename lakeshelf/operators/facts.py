"""Fact building: resolve natural keys to dimension surrogate ids with left
lookups, and the gated incremental load around it."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshelf.session import checked_broadcasts, materialize, scratch_scope
from lakeshelf.sources import io, state


@dataclass
class Lookup:
    """``dim`` rows (optionally filtered by ``where``) matched on
    ``on`` = {dim column: fact column name or expression}; the dim's ``take``
    column is returned as ``alias``. ``null_safe`` uses ``<=>``."""
    dim: DataFrame
    on: Mapping[str, str | Column]
    take: str
    alias: str
    where: Column | None = None
    null_safe: bool = False
    stored: bool = True  # the dimension is a stored table (count it in place)


def resolve_keys(fact: DataFrame, lookups: Sequence[Lookup], keep: Sequence[str | Column]) -> DataFrame:
    """Left-join ``fact`` to every lookup and select ``keep`` plus the looked
    up ids. Unknown keys give NULL ids; fact rows are never dropped.

    Each dimension side is reduced to its key and id columns and broadcast
    only if its measured size is under the threshold; otherwise the join
    shuffles and AQE may split skewed fact partitions."""
    out = fact
    names_of = [[f"__l{i}_{j}" for j in range(len(lk.on))] for i, lk in enumerate(lookups)]
    sides = []
    for lk, names in zip(lookups, names_of):
        d = lk.dim.where(lk.where) if lk.where is not None else lk.dim
        d = d.select(*[F.col(dc).alias(n) for dc, n in zip(lk.on, names)], F.col(lk.take).alias(lk.alias))
        sides.append(d if lk.stored else materialize(d, "lookup"))
    for lk, names, d in zip(lookups, names_of, checked_broadcasts(sides)):
        conds = []
        for (dc, fc), n in zip(lk.on.items(), names):
            fcol = F.col(fc) if isinstance(fc, str) else fc
            conds.append(fcol.eqNullSafe(d[n]) if lk.null_safe else fcol == d[n])
        out = out.join(d, reduce(lambda a, b: a & b, conds), "left").drop(*names)
    ids = [lk.alias for lk in lookups]
    cols = [F.col(k) if isinstance(k, str) else k for k in keep]
    return out.select(*cols, *ids)


def incremental_steps(spark, state_root: str, mark_name: str, source: str,
                      step: Callable[[DataFrame, int, int], None], until: int | None = None) -> bool:
    """Gated increments over the versioned table at ``source``:

    current version (folder listing) -> last mark -> gate -> record the range
    -> ``step(changes in (since, until], since, until)`` -> move mark.

    The step writes version ``until`` of its targets, replacing that version.
    A failure before the mark moves is repaired by the next call: it finishes
    the recorded range first, whatever the source holds by then, so no row is
    written under two versions."""
    cur = until if until is not None else io.latest_version(spark, source)
    if cur is None:
        return False

    def run(last, upto):
        since = -1 if last is None else int(last)
        with scratch_scope(spark):
            step(io.read_changes(io.read_versions(spark, source), since, int(upto)), since, int(upto))

    return state.run_step(spark, state_root, mark_name, int(cur), run)


def incremental(spark, state_root: str, mark_name: str, source: str, target_path: str,
                transform: Callable[[DataFrame], DataFrame], until: int | None = None) -> bool:
    """:func:`incremental_steps` with one target: ``transform(changes)``
    becomes its version."""
    def step(changes, since, upto):
        io.append_version(transform(changes), target_path, version=upto)

    return incremental_steps(spark, state_root, mark_name, source, step, until)

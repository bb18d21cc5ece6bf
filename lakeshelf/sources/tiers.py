"""Additive tables in tiers: counts that grow by one run per load and are
merged so that few runs are left.

A load appends a run of level 0; as soon as ``fanout`` runs of a level are there,
they are summed into one of the next level. So after n loads there are at most
``(fanout - 1) * log(n)`` runs, and each count is rewritten once a level. Runs and
states are those of :mod:`lakeshelf.sources.runs`: a crash leaves the last state,
and a load that is repeated (same ``upto``) is not counted twice."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshelf.sources import runs

FANOUT = 4


def add(rows: DataFrame, path: str, upto: int, by: Sequence[str], fanout: int = FANOUT, weight: str = "__n") -> runs.State:
    """Add the counts of versions up to ``upto`` (with a BUCKET column) to the
    table, unless it holds them already, then merge full levels. ``by`` are the
    columns that a count belongs to."""
    spark = rows.sparkSession
    state = runs.newest(spark, path)
    if state.info.get("upto", upto - 1) < upto:
        run, held = runs.write_run(rows, path, state)

        def change(now: runs.State) -> runs.State:
            if now.info.get("upto", upto - 1) >= upto:
                raise runs.Conflict(f"{path} already holds version {upto}")
            lists = {**now.runs, **{b: [*now.runs.get(b, []), run] for b in held}}
            return runs.State(0, lists, {**now.info, "upto": upto, "levels": {**now.info.get("levels", {}), run: 0}})

        state = runs.publish(spark, path, change)
    while True:
        levels = state.info.get("levels", {})
        full = next((n for n in sorted(set(levels.values())) if sum(x == n for x in levels.values()) >= fanout), None)
        if full is None:
            break
        state = _merge(spark, path, state, [r for r, n in levels.items() if n == full], full + 1, rows.schema, by, weight)
    runs.retire(spark, path)
    return state


def _merge(spark: SparkSession, path: str, state: runs.State, merged: list[str], level: int, schema, by: Sequence[str], weight: str) -> runs.State:
    part = runs.State(state.number, {b: [r for r in rs if r in merged] for b, rs in state.runs.items()})
    rows = runs.read(spark, path, schema, part, with_buckets=True)
    total = rows.groupBy(runs.BUCKET, *by).agg(F.sum(weight).alias(weight))
    run, held = runs.write_run(total, path, state)

    def change(now: runs.State) -> runs.State:
        levels = now.info["levels"]
        if not set(merged) <= set(levels):
            raise runs.Conflict(f"runs of {path} were merged by another writer")
        lists = {}
        for b in set(now.runs) | set(held):
            kept = [r for r in now.runs.get(b, []) if r not in merged]
            lists[b] = ([run] if b in held else []) + kept
        levels = {r: n for r, n in levels.items() if r not in merged} | {run: level}
        return runs.State(0, {b: r for b, r in lists.items() if r}, {**now.info, "levels": levels})

    return runs.publish(spark, path, change)

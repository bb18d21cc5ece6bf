"""Selection medians and the tiered imputation history."""

import glob
import math
import os
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lakeshelf.operators import impute as im
from lakeshelf.operators import selection as sel
from lakeshelf.plans import silver
from lakeshelf.sources import runs, tiers


def test_grid_never_falls(spark):
    rng = random.Random(1)
    xs = sorted([0.0, -0.0, 5e-324, -5e-324, 1.7e308, -1.7e308, math.inf, -math.inf, *[rng.choice([-1, 1]) * math.exp(rng.uniform(-700, 700)) for _ in range(3000)],
                 *[x for k in range(-60, 60) for x in (2.0 ** k, math.nextafter(2.0 ** k, 0))]])
    df = spark.createDataFrame([(x,) for x in xs], "x double").coalesce(1)
    bins = [r.b for r in df.select(sel.grid_bin(F.col("x")).alias("b")).collect()]
    assert bins == sorted(bins) and bins.count(0) == 2


@pytest.mark.parametrize("few", [100_000, 20])
def test_medians_by_selection(spark, monkeypatch, few):
    monkeypatch.setattr(sel, "FEW", few)
    rng = random.Random(2)
    rows = [("even", float(x)) for x in (1, 2, 10, 20)] + [("one", 7.0), ("ties", 3.0), ("ties", 3.0), ("none", None), ("nan", float("nan")), (None, -1.5), (None, -2.5)]
    rows += [("close", 1000.0 + k / 7e6) for k in range(501)] + [("same", 5.0)] * 400
    rows += [("wide", rng.choice([-1, 1]) * math.exp(rng.uniform(-300, 300))) for _ in range(500)] + [("inf", math.inf), ("inf", 1.0), ("inf", 2.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    for interpolate in (False, True):
        got = {r.g: r.m for r in im.exact_median(df, "g", "v", interpolate, "m").collect()}
        want = {}
        for g in {r[0] for r in rows} - {"none", "nan"}:
            x = sorted(v for h, v in rows if h == g)
            lo, hi = x[(len(x) - 1) // 2], x[len(x) // 2]
            want[g] = (lo + hi) / 2 if interpolate else lo
        assert got == want
    big = spark.createDataFrame([(1, 2 ** 62 + k) for k in range(101)], "g int, v long")
    assert im.exact_median(big, "g", "v", False).first()[1] == 2 ** 62 + 50


def test_tiers_hold_few_runs_and_count_once(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    schema = "k string, __n bigint"
    want = {}
    for v in range(22):
        rows = [(k, v + 1) for k in ("a", "b", f"x{v}")]
        for k, n in rows:
            want[k] = want.get(k, 0) + n
        df = spark.createDataFrame(rows, schema).withColumn(runs.BUCKET, F.when(F.col("k") < "x", 0).otherwise(7))
        for _ in range(2 if v % 7 == 0 else 1):  # a repeated load counts once
            tiers.add(df, path, v, ["k"])
        held = runs.newest(spark, path).info["levels"]
        assert len(held) <= 3 * (1 + math.log(v + 1, 4))
    got = runs.read(spark, path, schema).groupBy("k").agg(F.sum("__n").alias("n"))
    assert {r.k: r.n for r in got.collect()} == want
    assert {r[0] for r in runs.read(spark, path, schema, buckets=[7]).select("k").collect()} == {f"x{v}" for v in range(22)}
    assert len(glob.glob(f"{tmp_path}/t/run-*")) <= len(held) + 6  # merged runs are deleted


def test_history_reads_the_middle_bins_only(spark, tmp_path):
    rng = random.Random(3)
    root, every = f"file://{tmp_path}/h", []
    for v in range(9):
        rows = [(f"d{rng.randrange(3)}", math.exp(rng.gauss(6, 2)), *[rng.randrange(4) for _ in silver.MODE_COLUMNS]) for _ in range(400)]
        every += rows
        cols = ", ".join(["district string", "area double", *[f"{c} int" for c in silver.MODE_COLUMNS]])
        df = spark.createDataFrame(rows, cols)
        silver.add_history(df, root, v)
        lk = silver.history_lookups(spark, root, {c: df.schema[c].dataType for c in silver.MODE_COLUMNS})
        got = {r["__grp"]: r for r in lk.collect()}
        frame = pd.DataFrame(every, columns=["district", "area", *silver.MODE_COLUMNS])
        for d, part in frame.groupby("district"):
            assert got[d]["median_area"] == sorted(part["area"])[(len(part) - 1) // 2]
            for c in silver.MODE_COLUMNS:
                assert got[d][f"mode_{c}"] == part[c].mode().min()
        values = {f for f in lk.inputFiles() if "median_values" in f}
        state = runs.newest(spark, f"{root}/median_values")
        stored = sum(os.path.getsize(f) for f in glob.glob(f"{tmp_path}/h/median_values/run-*/*/*.parquet"))
        assert sum(os.path.getsize(f.replace("file://", "")) for f in values) < 0.25 * stored
        assert max(len(r) for r in state.runs.values()) <= 3 * (1 + math.log(v + 1, 4))

"""Property checks of the distributed building blocks against brute force
in pandas on small random frames (hot keys and repeated values included)."""

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lakeshelf.operators import dims as dm
from lakeshelf.operators import impute as im

_SET = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

groups = st.sampled_from(["a", "b", "c", None])
values = st.one_of(st.none(), st.integers(min_value=0, max_value=6))
rows = st.lists(st.tuples(groups, values), min_size=1, max_size=60)


@_SET
@given(rows)
def test_exact_median_matches_pandas(spark, data):
    df = spark.createDataFrame(data, "g string, v int").repartition(3)
    pdf = pd.DataFrame(data, columns=["g", "v"]).dropna(subset=["v"])
    want = {k: float(v) for k, v in pdf.groupby("g", dropna=False)["v"].median().items()}
    got = {k: float(v) for k, v in im.exact_median(df, "g", "v").collect()}
    want = {(None if isinstance(k, float) else k): v for k, v in want.items()}
    assert got == want


@_SET
@given(rows)
def test_mode_matches_bruteforce(spark, data):
    df = spark.createDataFrame(data, "g string, v int")
    got = dict(im.mode_by_group(df, "g", "v").collect())
    want = {}
    for g in {r[0] for r in data}:
        vals = [v for k, v in data if k == g and v is not None]
        if vals:
            counts = pd.Series(vals).value_counts()
            top = counts.max()
            want[g] = min(int(v) for v, c in counts.items() if c == top)
    assert got == want


@_SET
@given(st.lists(st.integers(min_value=-50, max_value=50), min_size=1, max_size=80, unique=True),
       st.integers(min_value=1, max_value=5))
def test_surrogate_ids_follow_key_order(spark, keys, parts):
    df = spark.createDataFrame([(k,) for k in keys], "k int")
    got = sorted((r["k"], r["id"]) for r in dm.with_surrogate_key(df, ["k"], start=100, partitions=parts).collect())
    assert [i for _, i in got] == list(range(101, 101 + len(keys)))


@_SET
@given(st.lists(st.tuples(st.sampled_from([1, 2]), st.integers(0, 3)), min_size=1, max_size=40))
def test_weighted_positions_are_prefix_sums(spark, data):
    df = spark.createDataFrame(data, "g int, w int").groupBy("g", "w").count()
    got, ranged = (sorted(tuple(r) for r in dm.positions(df, ["g", "w"], weight="count", partitions=p).select("g", "w", "count", "__pos").collect())
                   for p in (None, 3))
    assert got == ranged
    run, want = 0, []
    for g, w, c in sorted((r[0], r[1], r[2]) for r in df.collect()):
        want.append((g, w, c, run))
        run += c
    assert got == want

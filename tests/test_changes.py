"""Row-level changes against plain Python, with NULL keys and values."""

import random

import pytest

from lakeshelf.sources import changes as ch

SCHEMA = "k1 long, k2 string, `v.x` double, w string"


def states(seed, n=4):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        keys = {(rng.choice([None, *range(8)]), rng.choice(["a", None])) for _ in range(12)}
        out.append({k: (rng.choice([None, 1.0, 2.0]), rng.choice([None, "p"])) for k in keys})
    return out


def plain(old, new):
    rows = []
    for k in old.keys() | new.keys():
        if k not in old:
            rows.append(("insert", *k, *new[k]))
        elif k not in new:
            rows.append(("delete", *k, *old[k]))
        elif old[k] != new[k]:
            rows += [("update_preimage", *k, *old[k]), ("update_postimage", *k, *new[k])]
    return sorted(rows, key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_changes_net_and_apply(spark, seed):
    s = states(seed)
    frame = lambda d: spark.createDataFrame([(*k, *v) for k, v in d.items()], SCHEMA)
    got = lambda df: sorted(map(tuple, df.collect()), key=str)
    keys, feed = ["k1", "k2"], None
    for v in range(1, len(s)):
        c = ch.row_changes(frame(s[v - 1]), frame(s[v]), keys)
        assert got(c) == plain(s[v - 1], s[v])
        c = c.selectExpr("*", f"{v} AS _commit_version")
        feed = c if feed is None else feed.unionByName(c)
    net = ch.net(feed, keys)
    assert got(net) == plain(s[0], s[-1])
    once = ch.apply(frame(s[0]), net, keys)
    want = sorted(((*k, *v) for k, v in s[-1].items()), key=str)
    assert got(once) == want and got(ch.apply(once, net, keys)) == want
    assert ch.row_changes(frame(s[0]), frame(s[0]), keys).count() == 0
    assert ch.signed(net).groupBy().sum("__sign").first()[0] == len(s[-1]) - len(s[0])


def test_one_comparison(spark):
    a, b = (spark.range(10).selectExpr("id AS k", f"id % {m} AS v") for m in (3, 2))
    text = ch.row_changes(a, b, ["k"])._jdf.queryExecution().simpleString()
    assert text.count("FullOuter") >= 1 and "CartesianProduct" not in text and "NestedLoop" not in text

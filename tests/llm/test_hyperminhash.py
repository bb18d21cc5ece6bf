"""HyperMinHash near-duplicates against brute force over whole texts."""

import random

import numpy as np
import pytest

from lakeshelf.llm import hyperminhash as H


def plain_set(text, k=4):
    w = (text or "").translate({c: c + 32 for c in range(65, 91)})
    for c in "\t\n\x0b\x0c\r":
        w = w.replace(c, " ")
    w = [x for x in w.split(" ") if x]
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute(docs, percent=80):
    sets = [plain_set(t) for _, t in docs]
    comp = list(range(len(docs)))

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                comp[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    out = []
    for i, (d, _) in enumerate(docs):
        c = low.get(find(i)) if sets[i] else d
        out.append((d, len(sets[i]), c, d is not None and d == c))
    return sorted(out, key=str)


def corpus(seed=4):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    docs = []
    line = " ".join(rnd.choice(words) for _ in range(30))
    for n in (1, 2, 3, 4, 5, 6, 8, 12, 20, 40, 120, 400, 3000):
        for _ in range(2):
            base = [rnd.choice(words) for _ in range(n)]
            for edits in (0, 0, 1, 1, 2, 3, max(1, n // 40), max(1, n // 25), max(1, n // 18), n // 8):
                w = list(base)
                for _ in range(edits):
                    w[rnd.randrange(len(w))] = rnd.choice(words)
                docs.append(" ".join(w).upper() if rnd.random() < 0.2 else " \n".join(w))
    docs += [line + " " + " ".join(rnd.choice(words) for _ in range(25)) for _ in range(30)]
    chain = [rnd.choice(words) for _ in range(100)]
    for _ in range(25):  # a chain of near copies whose ends are far apart
        chain = list(chain)
        chain[rnd.randrange(100)] = rnd.choice(words)
        docs.append(" ".join(chain))
    docs += ["", None, " \t\n", "İstanbul ÄÖ ǅ", "İstanbul äö ǅ", "a b c"]
    ids = rnd.sample(range(10_000), len(docs))
    docs = list(zip(ids, docs))
    return docs + docs[::9] + [(None, docs[3][1]), (None, "only here and nowhere else at all")]


@pytest.fixture(scope="module")
def expected():
    return brute(corpus())


@pytest.mark.parametrize("limits", [{}, {"cap": 3}])
def test_near_duplicates_equal_brute_force(spark, expected, limits):
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in corpus()], "doc_id long, text string, component long, sketch string")
    got = H.near_duplicates(df, **limits)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(map(tuple, got.collect()), key=str) == expected
    assert H.near_duplicates(df.where("false")).count() == 0


def test_groups_too_large_for_a_task_go_bucket_by_bucket(spark, expected):
    df = spark.createDataFrame(corpus(), "doc_id long, text string")
    rows = H.materialize(H.sketches(df), "t").where("set_key IS NOT NULL")
    distinct = rows.groupBy("set_key").agg(H.F.min("doc_id").alias("low"), H.F.first("n_shingles").alias("n"), H.F.min("text_key").alias("text_key"),
                                           H.F.first("sketch").alias("sketch"))
    distinct = H.materialize(distinct.withColumn("id", H.F.monotonically_increasing_id()), "t")
    whole = H.components(H.links(df, distinct, 4, 80, 4096)).count()
    split = H.components(H.links(df, distinct, 4, 80, 4096, cap_bytes=2000)).count()
    assert whole == split > 50


def test_estimates_and_chance_collisions():
    rng = np.random.default_rng(8)
    for n, share in ((60, 0.8), (700, 0.8), (20_000, 0.8), (20_000, 0.5), (20_000, 0.0)):
        both = rng.integers(0, 2 ** 63, size=int(2 * n * share / (1 + share)), dtype=np.uint64) * np.uint64(2)
        a, b = (np.unique(np.concatenate([both, rng.integers(0, 2 ** 63, size=n - len(both), dtype=np.uint64) * np.uint64(2) + np.uint64(1)])) for _ in range(2))
        est, error = H.similarity(H.registers(a), len(a), H.registers(b), len(b))
        true = len(both) / (2 * n - len(both))
        assert abs(est - true) < 4 * max(error, 0.01 if share else 0.02), (n, share, est)


def test_registers_keep_zeros_and_mantissa():
    top = np.uint64(5) << np.uint64(55)
    for zeros, bits in ((0, 0), (0, 15), (3, 9), (13, 1)):
        fraction = (2.0 ** -(zeros + 1)) * (1 + (bits + 0.5) / 16)
        h = np.array([top + np.uint64(int(fraction * 2 ** 55))], dtype=np.uint64)
        r = H.registers(h)
        assert np.flatnonzero(r).tolist() == [5] and r[5] == 1 + zeros * 16 + bits
    assert not H.registers(np.zeros(0, dtype=np.uint64)).any()


def test_bands_find_pairs_at_the_threshold():
    """At similarity 0.8, pairs of every size share a band."""
    rng = random.Random(1)
    missed = 0
    for n in [5] * 200 + [9, 45, 90, 450, 4500] * 20:
        union = [rng.getrandbits(64) for _ in range(n)]
        cut = n // 10 or (n == 5)
        a, b = (union[cut:], union) if n == 5 else (union[:n - cut], union[cut:])
        keys = [set(H.band_keys(H.registers(np.unique(np.array(x, dtype=np.uint64)))).tolist()) for x in (a, b)]
        missed += not keys[0] & keys[1]
    assert missed == 0

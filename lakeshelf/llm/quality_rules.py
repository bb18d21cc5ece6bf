"""Quality rules as learned decision lists.

Statistics of every whole text are computed in Arrow batches. Sequential
covering learns, from labelled statistics, an ordered list of conjunctions of
thresholds: a rule is grown on two thirds of the rows left (best gain in
information about the rejected class), pruned on the other third, and kept if
it is precise there; the rows that it covers are removed and the next rule is
learned. The list becomes one ordered ``F.when`` chain, so applying it is a
Spark column expression.

Defined cases: null or empty text has no words, all statistics are 0 and the
base rule rejects it; without labelled rows (or with one class) the list is
empty and the verdict is "keep"; repeated rows are judged alike; labels with
null, or labels that disagree on one id, are ignored / each used."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

SYMBOLS = b"#*$%&|<>"
BASE_STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: What the rules may test; all are ratios, so no rule depends on length alone.
FEATURES = ("mean_word", "symbols_per_word", "dup_line_share", "repeat_share", "upper_share",
            "digit_share", "punct_share", "unique_share", "stop_end_share", "top_word_share")
STATS_SCHEMA = ", ".join(f"{c} long" for c in BASE_STATS) + ", n_lines long, " + ", ".join(f"{c} double" for c in FEATURES)

_KEEP_SYMBOLS = bytes(i for i in range(256) if i not in SYMBOLS)
_UPPER = bytes(i for i in range(256) if not 65 <= i <= 90)
_DIGIT = bytes(i for i in range(256) if not 48 <= i <= 57)
_PUNCT = bytes(i for i in range(256) if not (33 <= i <= 47 or 58 <= i <= 64 or 91 <= i <= 96 or 123 <= i <= 126))
_CONT = bytes(range(128, 192))


def repeat_words(ids: np.ndarray) -> int:
    """Positions inside any 3-item window whose content occurs at least twice."""
    n = len(ids)
    if n < 4:
        return 0
    width = int(ids.max()) + 1
    pair = ids[:-1] * width + ids[1:]
    if width >= 1 << 20:
        pair = np.unique(pair, return_inverse=True)[1]
    key = pair[:-1] * width + ids[2:]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    hit = np.zeros(n - 2, dtype=bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    word = np.zeros(n, dtype=bool)
    word[:-2] |= hit
    word[1:-1] |= hit
    word[2:] |= hit
    return int(word.sum())


def text_stats(raw: bytes) -> tuple:
    """Statistics of one UTF-8 text in the order of STATS_SCHEMA."""
    words = raw.split()  # bytes.split: exactly space and \t \n \v \f \r
    n = len(words)
    if not n:
        return (0, 0, len(raw.translate(None, _KEEP_SYMBOLS)), 0, 0, 0) + (0.0,) * len(FEATURES)
    joined = b"".join(words)
    chars = len(joined.translate(None, _CONT))
    symbols = len(raw.translate(None, _KEEP_SYMBOLS))
    seen: set[bytes] = set()
    dup = lines = 0
    for line in raw.split(b"\n"):
        if line.strip():  # ASCII white space only, as in split
            lines += 1
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=n)
    repeat = repeat_words(ids)
    letters = max(1, chars)
    ends = sum(1 for w in words if w[-1] in b".!?")
    return (n, chars, symbols, dup, repeat, lines,
            chars / n, symbols / n, dup / max(1, lines), repeat / n,
            len(joined.translate(None, _UPPER)) / letters, len(joined.translate(None, _DIGIT)) / letters,
            len(joined.translate(None, _PUNCT)) / letters, len(number) / n, ends / n,
            float(np.bincount(ids).max()) / n)


def with_stats(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns and the statistics of every whole text."""
    schema = ", ".join(f"{C.q(f.name)} {f.dataType.simpleString()}" for f in docs.schema.fields if f.name in keep)
    names = [c for c in docs.columns if c in keep]
    raw = text if text in names else "_raw"
    src = docs.select(*[C.ref(c) for c in names], *([] if raw == text else [C.ref(text).alias(raw)]))
    stat_names = [*BASE_STATS, "n_lines", *FEATURES]
    ints = len(BASE_STATS) + 1

    def kernel(b):
        cols = list(zip(*[text_stats(t) for t in C.raw_texts(b, raw)]))
        arrays = [b.column(c) for c in names]
        arrays += [pa.array(c, pa.int64() if i < ints else pa.float64()) for i, c in enumerate(cols)]
        return pa.RecordBatch.from_arrays(arrays, names=names + stat_names)

    return C.map_batches(src, kernel, f"{schema}, {STATS_SCHEMA}", raw)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Rule:
    """A conjunction of (feature, ">=" or "<", threshold) that rejects."""
    tests: tuple[tuple[str, str, float], ...]

    def column(self) -> Column:
        out = F.lit(True)
        for name, op, at in self.tests:
            out = out & ((F.col(name) >= F.lit(at)) if op == ">=" else (F.col(name) < F.lit(at)))
        return out

    def mask(self, x: dict[str, np.ndarray]) -> np.ndarray:
        out = np.ones(len(next(iter(x.values()))), dtype=bool)
        for name, op, at in self.tests:
            out &= (x[name] >= at) if op == ">=" else (x[name] < at)
        return out


def _grow(x: dict[str, np.ndarray], y: np.ndarray, features, max_tests: int) -> list[tuple[str, str, float]]:
    """Adds the test of the best information gain until every covered row is
    of the rejected class or nothing gains."""
    tests: list[tuple[str, str, float]] = []
    live = np.arange(len(y))
    while len(tests) < max_tests:
        p0, n0 = int(y[live].sum()), int((~y[live]).sum())
        if p0 == 0 or n0 == 0:
            break
        base = np.log2(p0 / (p0 + n0))
        best = (1e-9, None, None)
        for name in features:
            v = x[name][live]
            cuts = np.unique(np.quantile(v, np.linspace(0.005, 0.995, 199)))
            order = np.argsort(v, kind="stable")
            at = np.searchsorted(v[order], cuts, side="left")
            pos = np.concatenate([[0], np.cumsum(y[live][order])])
            for op in (">=", "<"):
                p = (p0 - pos[at]) if op == ">=" else pos[at]
                cover = (len(v) - at) if op == ">=" else at
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where((p > 0), p * (np.log2(p / cover) - base), -1.0)
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (float(gain[k]), (name, op, float(cuts[k])), None)
        if best[1] is None:
            break
        tests.append(best[1])
        live = live[Rule((best[1],)).mask({k: v[live] for k, v in x.items()})]
    return tests


def learn(x: dict[str, np.ndarray], rejected: np.ndarray, features=FEATURES, max_rules: int = 12,
          max_tests: int = 4, min_precision: float = 0.9, min_cover: int = 5, seed: int = 7) -> list[Rule]:
    """Ordered rules for the rejected class (``rejected``: bool per row)."""
    rules: list[Rule] = []
    rng = np.random.default_rng(seed)
    live = np.arange(len(rejected))
    while len(rules) < max_rules and rejected[live].any() and not rejected[live].all():
        perm = rng.permutation(live)
        cut = (2 * len(perm)) // 3
        grow, prune = np.sort(perm[:cut]), np.sort(perm[cut:])
        part = lambda rows: {k: x[k][rows] for k in features}
        tests = _grow(part(grow), rejected[grow], features, max_tests)
        if not tests:
            break
        xp, yp = part(prune), rejected[prune]

        def worth(t):
            m = Rule(tuple(t)).mask(xp)
            p, n = int(yp[m].sum()), int((~yp[m]).sum())
            return (p - n) / max(1, p + n), p

        while len(tests) > 1 and worth(tests[:-1]) >= worth(tests):
            tests = tests[:-1]
        rule = Rule(tuple(tests))
        every = part(live)
        m = rule.mask(every)
        good, bad = int(rejected[live][m].sum()), int((~rejected[live][m]).sum())
        mp = rule.mask(xp)
        gp, bp = int(yp[mp].sum()), int((~yp[mp]).sum())
        if good < min_cover or good < min_precision * (good + bad) or gp < min_precision * (gp + bp):
            break
        rules.append(rule)
        live = live[~m]
    return rules


def rejects(rules: list[Rule]) -> Column:
    """The list as one ordered conditional: number of the first rule that
    fits (from 1), or 0 for "keep"."""
    out = None
    for i, r in enumerate(rules, 1):
        out = F.when(r.column(), i) if out is None else out.when(r.column(), i)
    return F.lit(0) if out is None else out.otherwise(0)


def learn_from_labels(docs: DataFrame, labels: DataFrame, train_rows: int = 12_000, **kw) -> list[Rule]:
    """Learns from at most ``train_rows`` labelled rows (a documented bound:
    those of the smallest id hash, so the choice does not depend on layout).
    Rows whose crc32(id) mod 3 is 1 are left out for evaluation."""
    lab = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & (C.crc32_of_id() % 3 != 1))
           .select(F.col("doc_id").cast("long").alias("_id"), (F.col("quality") == 0).alias("_bad"))
           .orderBy(F.xxhash64("_id"), "_id", "_bad").limit(train_rows))
    sample = (docs.select(F.col("doc_id").cast("long").alias("_id"), "text")
              .join(F.broadcast(lab), "_id"))  # at most train_rows rows of 9 bytes
    rows = (with_stats(sample, "text", ("_id", "_bad"))
            .where(~base_failed())
            .orderBy(F.xxhash64("_id"), "_id", "n_words", "word_chars", "n_symbols").limit(train_rows)
            .select("_bad", *FEATURES).toPandas())
    if not len(rows):
        return []
    x = {c: rows[c].to_numpy(dtype=float) for c in FEATURES}
    return learn(x, rows["_bad"].to_numpy(dtype=bool), **kw)


def with_verdict(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds ``base_failed``, ``rule`` (the first rule that rejects, 0: none)
    and ``kept`` to statistics."""
    return (stats.withColumn("base_failed", base_failed()).withColumn("rule", rejects(rules))
            .withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0)))


def judge(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """Per row: doc_id, statistics, ``base_failed``, ``rule`` and ``kept``."""
    return with_verdict(with_stats(docs), rules)


def filter_documents(docs: DataFrame, labels: DataFrame, train_rows: int = 12_000) -> DataFrame:
    """The documents that pass the base rule and the learned list, with the
    columns they came with."""
    rules = learn_from_labels(docs, labels, train_rows)
    src, own = C.private(docs)
    judged = with_verdict(with_stats(src, own["text"], tuple(own.values())), rules)
    return C.public(judged.where("kept"), own)

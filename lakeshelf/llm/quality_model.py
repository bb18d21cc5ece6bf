"""Quality classifier: hashed word n-gram logistic regression, trained with
follow-the-regularised-leader (FTRL-proximal) updates.

A text becomes words, digit runs and punctuation runs. Features are word
unigrams and bigrams and the 1- to 3-grams of word shapes (case, digits,
punctuation, "same as the last word"), hashed into 2^18 places; a feature's
value is its share among the text's n-grams. A score is the sparse dot
product, taken as a mean of gathered weights.

Training reads a bounded sample of labelled rows (``train_rows``, those with
the smallest id hash), dealt over ``shards``; each shard makes several FTRL
passes over its rows in a fixed order and the shards' weights are averaged.

Defined cases: null or empty text scores the bias alone; without labelled rows
every score is 0.5; repeated rows score alike; labels that are null are not
used, several labels of one id are each used."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

BITS = 18
SCALE = 30.0
_TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _shape(w: str) -> str:
    if w.isalpha():
        return "x" if w.islower() else "X" if w.isupper() and len(w) > 1 else "Xx" if w[0].isupper() else "xX"
    return "9" if w.isdigit() else w[:3]


class Vocabulary(dict):
    """Word -> (hash of the lower-cased word, hash of its shape); emptied when
    it holds ``limit`` words."""

    def __init__(self, limit: int = 300_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, w: str) -> tuple[int, int]:
        if len(self) >= self.limit:
            self.clear()
        h = self[w] = (xxhash.xxh64_intdigest(w.lower(), 1), xxhash.xxh64_intdigest(_shape(w), 2))
        return h


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(31)
    return x * np.uint64(0x94D049BB133111EB) >> np.uint64(64 - BITS)


def places(text: str, words: Vocabulary) -> np.ndarray:
    """Hashed place of every n-gram of the text, repeats included."""
    tokens = _TOKEN.findall(text)
    n = len(tokens)
    if not n:
        return np.zeros(0, dtype=np.int64)
    pairs = np.array([words[t] for t in tokens], dtype=np.uint64)
    w, s = pairs[:, 0], pairs[:, 1].copy()
    s[1:][w[1:] == w[:-1]] += np.uint64(77)  # same word as before
    s2 = s[:-1] * _MIX + s[1:]
    grams = [w, w[:-1] * _MIX + w[1:] + np.uint64(3), s + np.uint64(5), s2 + np.uint64(7),
             (s2[:-1] * _MIX + s[2:]) + np.uint64(11)]
    return _mix(np.concatenate(grams)).astype(np.int64)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], passes: int = 4, alpha: float = 0.3, beta: float = 1.0,
         l1: float = 0.02, l2: float = 0.001) -> np.ndarray:
    """Weights (the bias last) from (places, values, label) rows in order."""
    size = (1 << BITS) + 1
    z, n = np.zeros(size), np.zeros(size)

    def weights(zi, ni):
        out = -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2)
        return np.where(np.abs(zi) <= l1, 0.0, out)

    for _ in range(passes):
        for at, x, y in rows:
            w = weights(z[at], n[at])
            p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - y) * x
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    return weights(z, n)


def train(docs: DataFrame, labels: DataFrame, train_rows: int = 12_000, shards: int = 8) -> np.ndarray:
    """Weights from at most ``train_rows`` labelled rows whose crc32(id) mod 3
    is not 1 (the others are held out)."""
    lab = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & (C.crc32_of_id() % 3 != 1))
           .select(F.col("doc_id").cast("long").alias("_id"), (F.col("quality") == 1).cast("int").alias("_y"))
           .orderBy(F.xxhash64("_id"), "_id", "_y").limit(train_rows))
    # at most train_rows rows of 12 bytes are broadcast; an id that repeats in
    # the documents counts once in each shard task, by its first text
    sample = (docs.select(F.col("doc_id").cast("long").alias("_id"), "text").join(F.broadcast(lab), "_id")
              .groupBy("_id", "_y").agg(F.min("text").alias("text"))
              .withColumn("_o", F.xxhash64("_id")).repartition(shards, F.pmod("_o", F.lit(shards)))
              .sortWithinPartitions("_o", "_id", "_y"))

    def run(batches):
        words, rows, bias = Vocabulary(), [], np.array([1 << BITS])
        for b in C.chunks(batches):
            for t, y in zip(C.texts(b), b.column("_y").to_pylist()):
                at, k = np.unique(places(t, words), return_counts=True)
                rows.append((np.concatenate([at, bias]), np.concatenate([SCALE * k / max(1, k.sum()), [1.0]]), y))
        if rows:
            w = ftrl(rows)
            at = np.flatnonzero(w)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(w[at] * len(rows)), pa.array(np.full(len(at), len(rows)))],
                                             names=["at", "w", "n"])
            yield pa.RecordBatch.from_arrays([pa.array([-1]), pa.array([0.0]), pa.array([len(rows)])], names=["at", "w", "n"])

    learned = C.map_arrow(sample, run, "at long, w double, n long")
    total = learned.groupBy("at").agg(F.sum("w").alias("w"), F.sum("n").alias("n")).toPandas()  # at most 2^18 + 2 rows
    out = np.zeros((1 << BITS) + 1)
    if len(total):
        rows = int(total.loc[total["at"] == -1, "n"].iloc[0])
        use = total[total["at"] >= 0]
        out[use["at"].to_numpy()] = use["w"].to_numpy() / rows
    return out


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """(doc_id, score) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        w, words = shared.value, Vocabulary()
        for b in C.chunks(batches):
            logits = np.zeros(b.num_rows)
            for i, t in enumerate(C.texts(b)):
                at = places(t, words)
                logits[i] = w[-1] + (SCALE * w[at].mean() if len(at) else 0.0)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(logits, -35, 35))))],
                                             names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return C.map_arrow(docs.select("doc_id", "text"), run, f"doc_id {kind}, score double")

"""Benchmark contamination by winnowing.

Words of an item form windows of 10; a window's fingerprint is the smallest
hash among its 5-word grams (winnowing with gram 5 and window 6), so equal
windows always have equal fingerprints and every shared span of at least 10
words is found. Documents slide the same minimum over their words; positions
whose fingerprint may belong to the benchmark (a bit map of fixed size, built
by Spark) are joined with the benchmark's windows on fingerprint and words,
which extends each hit to the exact window. An item of fewer than 10 words is
one window; its fingerprint is the hash of all its words.

The benchmark may be large: its windows are joined by a shuffle unless Spark
sees that they are small, and the bit map only thins the candidates.

Defined cases: null or empty text has no words and no windows; repeated rows
get equal results; an item that has no words cannot occur; an empty benchmark
leaves every document clean; item ids are compared as text, null ids ignored."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import common as C

GRAM, SPAN = 5, 10
_M64 = np.uint64(0xFF51AFD7ED558CCD)
#: Separators become a space, A-Z become a-z; digits, a-z and bytes of
#: characters beyond ASCII stay.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(_FOLD).split()


class WordHashes(dict):
    """Hash of each word seen, emptied when it holds ``limit`` words."""

    def __init__(self, limit: int = 500_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, w: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = self[w] = xxhash.xxh64_intdigest(w, 11)
        return h


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k word hashes."""
    n = len(h) - k + 1
    out = np.zeros(max(0, n), dtype=np.uint64)
    if n <= 0:
        return out
    for j in range(k):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[j:j + n]
    out ^= out >> np.uint64(33)
    out *= _M64
    out ^= out >> np.uint64(29)
    return out


def window_prints(h: np.ndarray, n: int) -> np.ndarray:
    """Fingerprint of every window of n words: for the full span the minimum
    of its grams, for a short one the hash of the whole window."""
    if n < SPAN:
        return gram_hashes(h, n)
    g = gram_hashes(h, GRAM)
    m = len(h) - SPAN + 1
    if m <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = g[:m].copy()
    for j in range(1, SPAN - GRAM + 1):
        np.minimum(out, g[j:j + m], out=out)
    return out


def _hash_words(words: list[bytes], cache: WordHashes) -> np.ndarray:
    return np.fromiter(map(cache.__getitem__, words), dtype=np.uint64, count=len(words))


def item_windows(benchmark: DataFrame) -> DataFrame:
    """(item, n, fp, words): every window of every item."""

    def run(batches):
        cache = WordHashes()
        for b in C.chunks(batches):
            out = ([], [], [], [])
            for item, raw in zip(b.column("item").to_pylist(), C.raw_texts(b)):
                words = words_of(raw)
                n = min(SPAN, len(words))
                if not n:
                    continue
                fps = window_prints(_hash_words(words, cache), n).view(np.int64).tolist()
                out[0].extend([item] * len(fps))
                out[1].extend([n] * len(fps))
                out[2].extend(fps)
                out[3].extend(b" ".join(words[i:i + n]) for i in range(len(fps)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.string()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int64()),
                 pa.array(out[3], pa.binary()).cast(pa.string())], names=["item", "n", "fp", "words"])

    src = benchmark.where(F.col("item_id").isNotNull()).select(F.col("item_id").cast("string").alias("item"), "text")
    return C.map_arrow(src, run, "item string, n int, fp long, words string")


def print_map(windows: DataFrame, max_bits: int = 1 << 24) -> dict[int, np.ndarray]:
    """Per window length a bit map of the fingerprints; at most ``max_bits``
    bits in all lengths together reach the driver, however large the
    benchmark is (a fuller map only lets more candidates through)."""
    sizes = {r["n"]: r["c"] for r in windows.groupBy("n").agg(F.count(F.lit(1)).alias("c")).collect()}  # 10 rows at most
    out = {}
    for n, c in sizes.items():
        bits = 1 << 12
        while bits < 16 * c and bits < max_bits // 16:
            bits *= 2
        if n == SPAN:
            while bits < 16 * c and bits < max_bits // 2:
                bits *= 2
        at = F.col("fp").bitwiseAND(F.lit(bits - 1))
        rows = (windows.where(F.col("n") == n)
                .select(F.shiftright(at, 6).alias("i"), F.expr("shiftleft(1L, cast(fp & 63 as int))").alias("bit"))
                .groupBy("i").agg(F.bit_or("bit").alias("bits")).toPandas())
        m = np.zeros(bits // 64, dtype=np.uint64)
        m[rows["i"].to_numpy(dtype=np.int64)] = rows["bits"].to_numpy(dtype=np.int64).view(np.uint64)
        out[int(n)] = m
    return out


def _maybe(fps: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    at = fps & np.uint64(64 * len(bitmap) - 1)
    return np.flatnonzero((bitmap[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1))


def candidates(docs: DataFrame, bitmaps: dict[int, np.ndarray]) -> DataFrame:
    """(row, doc_id, text_hash, n_words, found): one row per document with
    the windows whose fingerprint may be the benchmark's. ``row`` numbers the
    rows once the result is written."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmaps)

    def run(batches):
        maps, cache, number = shared.value, WordHashes(), C.task_rows()
        for b in C.chunks(batches):
            counts, offsets = [], [0]
            out = ([], [], [], [])
            for raw in C.raw_texts(b):
                words = words_of(raw)
                counts.append(len(words))
                if words:
                    h = _hash_words(words, cache)
                    for n, bitmap in maps.items():
                        if n > len(words):
                            continue
                        fps = window_prints(h, n)
                        for i in _maybe(fps, bitmap).tolist():
                            out[0].append(i)
                            out[1].append(n)
                            out[2].append(int(fps[i].view(np.int64)))
                            out[3].append(b" ".join(words[i:i + n]))
                offsets.append(len(out[0]))
            found = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int64()),
                 pa.array(out[3], pa.binary()).cast(pa.string())], names=["at", "n", "fp", "words"]))
            first = number(b.num_rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(first, first + b.num_rows), pa.int64()), b.column("doc_id"), b.column("text_hash"),
                 pa.array(counts, pa.int64()), found], names=["row", "doc_id", "text_hash", "n_words", "found"])

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    return C.map_arrow(src, run, "row long, doc_id long, text_hash long, n_words long, "
                                 "found array<struct<at: long, n: int, fp: long, words: string>>")


def _covered(spans: str) -> str:
    """SQL: positions covered by a sorted array of (at, end)."""
    return (f"aggregate({spans}, named_struct('end', 0L, 'c', 0L), (acc, x) -> named_struct("
            "'end', greatest(acc.end, x.end), 'c', acc.c + greatest(0L, x.end - greatest(acc.end, x.at))), acc -> acc.c)")


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n_words, n_hit, items, contaminated) for every row
    of ``docs``: words inside any occurrence of an item's window, and the ids
    of those items in text order."""
    windows = materialize(item_windows(benchmark), "windows")
    found = materialize(candidates(docs, print_map(windows)), "candidates")
    # written, so that the join reads two plain shuffles and a window that
    # very many documents hold can be split
    per_window = materialize(windows.groupBy("fp", "n", "words").agg(F.collect_set("item").alias("items")), "per_window")
    hits = (found.select("row", F.explode("found").alias("f"))
            .select("row", F.col("f.fp").alias("fp"), F.col("f.n").alias("n"), F.col("f.words").alias("words"),
                    F.col("f.at").alias("at"))
            .join(per_window, ["fp", "n", "words"]))
    per_row = hits.groupBy("row").agg(
        F.sort_array(F.collect_set(F.struct("at", (F.col("at") + F.col("n")).alias("end")))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    out = found.select("row", "doc_id", "text_hash", "n_words").join(per_row, "row", "left")
    return out.select(
        "doc_id", "text_hash", "n_words", F.coalesce(F.expr(_covered("spans")), F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.col("spans").isNotNull().alias("contaminated"))


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any occurrence, with their columns."""
    bad = (contamination(docs, benchmark).where("contaminated")
           .select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct())
    src, own = C.private(docs)
    src = src.withColumn("_i", F.col(own["doc_id"]).cast("long")).withColumn("_h", F.xxhash64(own["text"]))
    on = [src["_i"].eqNullSafe(bad["_id"]), src["_h"] == bad["_hash"]]
    return C.public(src.join(bad, on, "left_anti"), own)

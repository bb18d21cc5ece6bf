"""MinHash near-duplicates on HyperMinHash sketches.

A text's set holds the 64-bit hashes of its distinct word shingles. The top 9
bits of a hash choose one of 512 buckets; of the smallest remaining fraction in
a bucket the sketch keeps the number of leading zeros and the next four bits, in
one byte (0: nothing fell there). From these registers come

* 64 band keys of six registers each. A band draws its buckets in a fixed random
  order and takes the first that are not empty, so short texts fill bands as
  well as long ones; two sets of similarity s share a band with probability
  s**6, and at 0.8 or more all 64 bands are missed once in 280 million pairs;
* the similarity of two sets: the share of equal registers, less the share
  that would be equal by chance at these set sizes (the collision correction).

Links need ``100 * intersection >= percent * union``, and no list of a group's
pairs is ever made: equal sets are one row; likely links (similarity well above
the threshold) of a bucket's members to its smallest member give provisional
components; within a bucket's task the members of different ones are joined
where their sketches allow the threshold (less five standard errors), by at
most as many edges as members. Whatever may be linked is then in one group,
whose whole sets meet once in one task, which confirms links on them while it
grows a spanning forest. A group above ``cap`` members or ``cap_bytes`` is worked
bucket by bucket instead, after its likely links are confirmed, and a bucket
above ``cap`` is split by a second shared band, which near-duplicates share as
surely as the first.

Defined cases: null or empty text and text without words have an empty set and
are linked with nothing; a null id never becomes a component's id unless no
other is there; repeated rows are one component; an empty table gives none."""

from __future__ import annotations

import functools
import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import common as C
from .components import components

BUCKET_BITS, MANTISSA_BITS, MOST_ZEROS = 9, 4, 14
BUCKETS = 1 << BUCKET_BITS
BANDS, ROWS = 64, 6
#: Bits of the map of texts whose sets are needed (fixed size, 2 MB). A fuller
#: map only lets more texts through, which an exact join drops.
MAP_BITS = 24


def shingle_hashes(raw: bytes, shingle: int) -> np.ndarray:
    """Sorted distinct hashes of a text's word shingles (A-Z lower-cased; fewer
    words: the whole sequence; no words: none)."""
    words = raw.lower().split()  # on bytes both are ASCII only
    if not words:
        return np.zeros(0, dtype=np.uint64)
    if len(words) <= shingle:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], dtype=np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    n = len(w) - shingle + 1
    h = np.full(n, shingle, dtype=np.uint64)
    for i in range(shingle):
        h = (h + w[i:i + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return np.unique((h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93))


def registers(hashes: np.ndarray) -> np.ndarray:
    """The sketch of sorted distinct hashes: a byte for each bucket."""
    out = np.zeros(BUCKETS, dtype=np.uint8)
    if not len(hashes):
        return out
    bucket = (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])  # sorted: the smallest of each bucket
    fraction = (hashes[first] << np.uint64(BUCKET_BITS)).astype(np.float64) / 2.0 ** 64
    mantissa, exponent = np.frexp(fraction)
    zeros = np.where(fraction > 0, np.minimum(-exponent, MOST_ZEROS), MOST_ZEROS)
    bits = np.where(fraction > 0, (mantissa - 0.5) * (2 << MANTISSA_BITS), 0).astype(np.int64)
    out[bucket[first]] = 1 + (np.maximum(zeros, 0) << MANTISSA_BITS) + np.minimum(bits, (1 << MANTISSA_BITS) - 1)
    return out


@functools.cache
def _draws() -> tuple[np.ndarray, np.ndarray]:
    """For each register draw of the bands, the buckets in random order, and
    each bucket's rank in it (a fixed rule, the same everywhere)."""
    order = np.argsort(np.random.RandomState(13).rand(BANDS * ROWS, BUCKETS), axis=1)
    return order.astype(np.int16), np.argsort(order, axis=1).astype(np.int16)


def band_keys(sketch: np.ndarray) -> np.ndarray:
    """The band keys (signed 64-bit) of a sketch that is not empty."""
    order, rank = _draws()
    filled = np.flatnonzero(sketch)
    if len(filled) < 64:
        bucket = filled[np.argmin(rank[:, filled], axis=1)]
    else:
        near = sketch[order[:, :40]] > 0
        place = np.argmax(near, axis=1)
        bucket = order[np.arange(len(order)), place].astype(np.int64)
        for i in np.flatnonzero(~near[np.arange(len(order)), place]).tolist():
            bucket[i] = order[i, np.argmax(sketch[order[i]] > 0)]
    drawn = ((bucket << 8) + sketch[bucket]).astype(np.uint64).reshape(BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for i in range(ROWS):
        key = (key + drawn[:, i]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(31)
    return key.view(np.int64)


@functools.cache
def _edges() -> np.ndarray:
    """Where each register value's interval of fractions starts and ends."""
    z, b = np.divmod(np.arange((MOST_ZEROS + 1) << MANTISSA_BITS), 1 << MANTISSA_BITS)
    width = 2.0 ** -(z + 1)
    low = width * (1 + b / (1 << MANTISSA_BITS))
    return np.stack([low, low + width / (1 << MANTISSA_BITS)])


@functools.lru_cache(maxsize=4096)
def _value_shares(n: int) -> np.ndarray:
    """How likely a bucket holds each register value, for a set of n hashes."""
    low, high = _edges()
    with np.errstate(divide="ignore"):
        keep = lambda x: np.exp(n * np.log1p(-x / BUCKETS))  # noqa: E731  no hash falls below x in the bucket
        return keep(low) - keep(high)


def chance(n: int, m: int) -> float:
    """How likely two unrelated sets of n and m hashes have equal registers in
    a bucket that is not empty in both."""
    empty = (1 - 1 / BUCKETS) ** (n + m)
    return float(_value_shares(n) @ _value_shares(m)) / (1 - empty)


def similarity(a: np.ndarray, n: int, b: np.ndarray, m: int) -> tuple[float, float]:
    """(estimated Jaccard similarity, its standard error at 0.8)."""
    return _similarity(int(((a == b) & (a > 0)).sum()), int(((a | b) > 0).sum()), n, m)


def _similarity(equal: int, used: int, n: int, m: int) -> tuple[float, float]:
    p = chance(n, m)
    union = (n + m) / 1.8  # at similarity 0.8; a bucket of each hash would leave no error
    error = math.sqrt(0.16 / used * max(0.0, 1 - used / union) + 1 / used ** 2) + 0.002
    return (equal / used - p) / (1 - p), error


def sketches(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(doc_id, n_shingles, set_key, text_key, sketch) of every whole text;
    set_key is the digest of the set, null if it is empty."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("text_key"))

    def kernel(b):
        n, keys, regs = [], [], []
        for t in C.raw_texts(b):
            h = shingle_hashes(t, shingle)
            n.append(len(h))
            keys.append(hashlib.blake2b(h.tobytes(), digest_size=16).digest() if len(h) else None)
            regs.append(registers(h).tobytes() if len(h) else None)
        return pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), b.column("text_key"),
                                           pa.array(regs, pa.binary())], names=["doc_id", "n_shingles", "set_key", "text_key", "sketch"])

    return C.map_batches(src, kernel, "doc_id long, n_shingles long, set_key binary, text_key binary, sketch binary")


def _buckets(distinct: DataFrame) -> DataFrame:
    """(key, band, id) of band keys that more than one set has."""

    def run(batches):
        for b in batches:
            for part in (b.slice(i, 512) for i in range(0, b.num_rows, 512)):
                regs = [np.frombuffer(x, dtype=np.uint8) for x in part.column("sketch").to_pylist()]
                keys = np.concatenate([band_keys(r) for r in regs])
                ids = np.repeat(part.column("id").to_numpy(), BANDS)
                band = np.tile(np.arange(BANDS, dtype=np.int16), len(regs))
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(band), pa.array(ids)], names=["key", "band", "id"])

    keyed = materialize(C.map_arrow(distinct.select("id", "sketch"), run, "key long, band short, id long"), "bands")
    several = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    return materialize(keyed.join(several, "key"), "buckets")


def _likely(distinct: DataFrame, buckets: DataFrame, percent: int, bands: int = 4) -> DataFrame:
    """(a, b): links of the first bands' members to their smallest member that
    are above the threshold by three standard errors."""
    some = buckets.where(F.col("band") < bands)
    low = some.groupBy("key").agg(F.min("id").alias("a"))
    pairs = materialize(some.join(low, "key").where("id != a").select("a", F.col("id").alias("b")).distinct(), "stars")
    regs = distinct.select("id", "n", "sketch")
    one = regs.toDF("a", "na", "ra")
    other = regs.toDF("b", "nb", "rb")

    def run(batches):
        for b in batches:
            cols = [b.column(c).to_pylist() for c in ("a", "b", "na", "nb", "ra", "rb")]
            out = []
            for x, y, n, m, r, s in zip(*cols):
                if 100 * min(n, m) < percent * max(n, m):
                    continue
                est, error = similarity(np.frombuffer(r, dtype=np.uint8), n, np.frombuffer(s, dtype=np.uint8), m)
                if est >= percent / 100 + 3 * error:
                    out.append((x, y))
            yield _pairs(out)

    return materialize(C.map_arrow(pairs.join(one, "a").join(other, "b"), run, "a long, b long"), "likely")


def _pairs(out: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[i] for p in out], pa.int64()) for i in (0, 1)], names=["a", "b"])


def _labelled(buckets: DataFrame, links: DataFrame) -> DataFrame:
    """The members of buckets that hold several components of ``links``."""
    comp = components(links)
    rows = buckets.join(comp.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    return materialize(_several(rows), "open")


def _several(rows: DataFrame) -> DataFrame:
    mixed = rows.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("size"))
    return rows.select("key", "id", "component").join(mixed.where("lo != hi").select("key", "size"), "key")


def _split(open_rows: DataFrame, buckets: DataFrame, cap: int) -> DataFrame:
    """Buckets with several components; those above ``cap`` members are
    replaced by their members' second shared bands."""
    small, large = open_rows.where(F.col("size") <= cap), open_rows.where(F.col("size") > cap)
    for _ in range(2):
        if large.isEmpty():
            break
        second = buckets.select("id", F.col("key").alias("other"))
        finer = large.select("key", "id", "component").join(second, "id").where(F.col("key") != F.col("other"))
        finer = finer.select(F.xxhash64(F.least("key", "other"), F.greatest("key", "other")).alias("key"), "id", "component").distinct()
        finer = materialize(_several(finer), "finer")
        small, large = small.unionByName(finer.where(F.col("size") <= cap)), finer.where(F.col("size") > cap)
    return small.unionByName(large).select("key", "id", "component")


def _by_key(rows: DataFrame, columns: tuple, compare) -> DataFrame:
    """(a, b) that ``compare`` gives for the rows of each key, which are
    streamed key by key in the order of their ids."""
    rows = rows.select(*columns).repartition("key").sortWithinPartitions("key", "id")

    def run(batches):
        key, held = None, []
        for b in batches:
            out = []
            for part in (b.slice(i, 256) for i in range(0, b.num_rows, 256)):  # long sets become Python values a few at a time
                for row in zip(*(part.column(c).to_pylist() for c in columns)):
                    if row[0] != key:
                        out += compare(held)
                        key, held = row[0], []
                    if not held or held[-1][1] != row[1]:
                        held.append(row)
            yield _pairs(out)
        yield _pairs(compare(held))

    return C.map_arrow(rows, run, "a long, b long")


def _forest(rows: list, percent: int, exact: bool) -> list[tuple[int, int]]:
    """Edges that join the components of one key's members as all their links
    do, at most one fewer than members. A link is a sketch that allows the
    threshold, and if ``exact`` a whole set that reaches it. Rows are (key, id,
    component, n, sketch[, hashes]); members of one component count as joined."""
    if len(rows) < 2:
        return []
    ids, n = [r[1] for r in rows], np.array([r[3] for r in rows])
    regs = np.stack([np.frombuffer(r[4], dtype=np.uint8) for r in rows])
    sets = [np.frombuffer(r[5], dtype=np.uint64) for r in rows] if exact else None
    mates: dict[int, list[int]] = {}
    for i, r in enumerate(rows):
        mates.setdefault(r[2], []).append(i)
    left = np.ones(len(rows), dtype=bool)
    edges = []
    for members in sorted(mates.values(), key=len, reverse=True):  # a large component's members are not compared with each other
        queue = [i for i in members if left[i]]
        left[queue] = False
        while queue:
            i = queue.pop()
            near = np.flatnonzero(left & (100 * np.minimum(n, n[i]) >= percent * np.maximum(n, n[i])))
            if not len(near):
                continue
            r = regs[near]
            equal = ((r == regs[i]) & (r > 0)).sum(axis=1)
            used = ((r | regs[i]) > 0).sum(axis=1)
            for j, e, u in zip(near.tolist(), equal.tolist(), used.tolist()):
                if not left[j] or e < (percent / 100 - 0.5) * u:
                    continue
                est, error = _similarity(e, u, int(n[i]), int(n[j]))
                if est < percent / 100 - 5 * error or exact and not _linked(sets[i], sets[j], percent):
                    continue
                edges.append((ids[i], ids[j]))
                joined = [m for m in mates[rows[j][2]] if left[m]]
                left[joined] = False
                queue += joined
    return edges


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    at = np.searchsorted(y, x)
    both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def _whole_sets(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """``wanted`` (id, text_key, n, sketch ...) with ``hashes``, from whole
    texts; a text that several tasks read comes several times. A bit map of
    the wanted texts spares the others the work."""
    spark = docs.sparkSession
    slot = F.conv(F.substring(F.hex("text_key"), 1, 8), 16, 10).cast("long").bitwiseAND((1 << MAP_BITS) - 1)
    words = (wanted.select(slot.alias("s")).groupBy(F.shiftright("s", 6).alias("w"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(s & 63 AS int))")).alias("b")).collect())  # at most 2^18 rows
    bits = np.zeros(1 << (MAP_BITS - 6), dtype=np.int64)
    for w, b in words:
        bits[w] = b
    shared = spark.sparkContext.broadcast(bits)
    src = docs.select("text", F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("text_key"))

    def run(batches):
        bits, seen = shared.value, set()
        for b in C.chunks(batches):
            keys = b.column("text_key").to_pylist()
            rows = []
            for i, k in enumerate(keys):
                s = int.from_bytes(k[:4], "big") & ((1 << MAP_BITS) - 1)
                if int(bits[s >> 6]) >> (s & 63) & 1 and k not in seen:
                    seen.add(k)
                    rows.append(i)
            raw = C.raw_texts(b.take(pa.array(rows, pa.int64()))) if rows else []
            yield pa.RecordBatch.from_arrays([pa.array([keys[i] for i in rows], pa.binary()),
                                              pa.array([shingle_hashes(t, shingle).tobytes() for t in raw], pa.binary())], names=["text_key", "hashes"])

    found = materialize(C.map_arrow(src, run, "text_key binary, hashes binary"), "sets")
    return materialize(found.join(wanted, "text_key"), "whole_sets")


def links(docs: DataFrame, distinct: DataFrame, shingle: int, percent: int, cap: int, cap_bytes: int = 64 << 20) -> DataFrame:
    """Edges (a, b) between distinct sets with the same components as all
    links of the threshold; for each set and key at most one."""
    buckets = _buckets(distinct)
    likely = _likely(distinct, buckets, percent)
    sketch = distinct.select("id", "n", "sketch")
    between = _by_key(_split(_labelled(buckets, likely), buckets, cap).join(sketch, "id"), ("key", "id", "component", "n", "sketch"),
                      lambda rows: _forest(rows, percent, False))
    # groups: whatever may be linked is in one
    group = components(likely.unionByName(between)).select(F.col("node").alias("id"), F.col("component").alias("key"))
    members = materialize(distinct.select("id", "text_key", "n", "sketch").join(group, "id"), "groups")
    sizes = materialize(members.groupBy("key").agg(F.count(F.lit(1)).alias("size"), (F.sum("n") * 8).alias("bytes")), "sizes")
    large = sizes.where((F.col("size") > cap) | (F.col("bytes") > cap_bytes)).select("key")
    columns, exact = ("key", "id", "component", "n", "sketch", "hashes"), lambda rows: _forest(rows, percent, True)
    sets = _whole_sets(docs, members, shingle)
    if large.isEmpty():
        return materialize(_by_key(sets.withColumn("component", F.col("id")), columns, exact), "links")
    small = _by_key(sets.join(large, "key", "left_anti").withColumn("component", F.col("id")), columns, exact)
    # a large group goes bucket by bucket, once its likely links are confirmed
    ids = materialize(members.join(large, "key").select("id"), "large")
    sets = materialize(sets.join(ids, "id").groupBy("id").agg(*[F.first(c).alias(c) for c in ("n", "sketch", "hashes")]), "large_sets")
    sure = _confirmed(likely.join(ids.withColumnRenamed("id", "a"), "a"), sets.select("id", "hashes"), percent)
    own = materialize(buckets.join(ids, "id"), "large_buckets")
    rest = _by_key(_split(_labelled(own, sure), own, cap).join(sets, "id"), columns, exact)
    return materialize(small.unionByName(sure).unionByName(rest), "links")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose whole sets reach the threshold."""

    def run(batches):
        for b in batches:
            out = []
            for i in range(b.num_rows):  # one row at a time: sets may be long
                x, y = (np.frombuffer(b.column(c)[i].as_py(), dtype=np.uint64) for c in ("ha", "hb"))
                if _linked(x, y, percent):
                    out.append((b.column("a")[i].as_py(), b.column("b")[i].as_py()))
            yield _pairs(out)

    whole = pairs.join(sets.toDF("a", "ha"), "a").join(sets.toDF("b", "hb"), "b")
    return materialize(C.map_arrow(whole, run, "a long, b long"), "confirmed")


def near_duplicates(docs: DataFrame, shingle: int = 4, percent: int = 80, cap: int = 4096) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): the smallest doc_id that each
    row reaches over links of ``100 * intersection >= percent * union``, and
    whether it is the row's own."""
    rows = materialize(sketches(docs, shingle), "sketches")
    filled = rows.where(F.col("set_key").isNotNull())
    distinct = filled.groupBy("set_key").agg(F.min("doc_id").alias("low"), F.first("n_shingles").alias("n"), F.min("text_key").alias("text_key"),
                                             F.first("sketch").alias("sketch"))
    distinct = materialize(distinct.withColumn("id", F.monotonically_increasing_id()), "distinct")
    comp = components(links(docs, distinct, shingle, percent, cap)).withColumnRenamed("node", "id")
    named = distinct.select("id", "set_key", "low").join(comp, "id", "left").withColumn("component", F.coalesce("component", "id"))
    named = materialize(named, "named")
    lowest = named.groupBy("component").agg(F.min("low").alias("component_id"))
    of_set = materialize(named.join(lowest, "component").select("set_key", "component_id"), "of_set")
    out = filled.select("doc_id", "n_shingles", "set_key").join(of_set, "set_key").select("doc_id", "n_shingles", "component_id")
    out = out.unionByName(rows.where(F.col("set_key").isNull()).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))

"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint has a bit for each of 64 positions: set if more than half of the
text's shingle hashes have it. For radius r, every bit position gets a nonzero
vector of r + 1 bits; each of the 2^(r+1) - 1 nonzero vectors v is a table,
whose mask keeps the positions that are not orthogonal to v. The vectors of
any r positions span at most r dimensions, so some v is orthogonal to all of
them: fingerprints that differ in at most r bits are equal under that table's
mask. No pair within the radius is missed.

Only distinct fingerprints are compared. A bucket of up to ``cap`` of them is
compared within one task and gives a spanning forest, never all pairs. The
members of a larger bucket go an exact way that needs no pairs: two
fingerprints are within 2 bits exactly if their balls of radius 1 meet, so
each is linked to the smallest fingerprint at each point of its ball.

Defined cases: null or empty text has fingerprint 0 and is linked like any
other; a null id never becomes a component's id unless no other is there;
repeated rows share fingerprint and component; an empty table gives none."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import common as C
from .components import components

BITS = 64


def fingerprint(raw: bytes, shingle: int = 3, seed: int = 42) -> int:
    """SimHash of a text: words after A-Z are lower-cased, ``shingle`` of them
    joined by a space (fewer: all of them), XXH64."""
    words = raw.lower().split()  # on bytes both are ASCII only
    if not words:
        return 0
    h64 = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return h64(b" ".join(words), seed)
    parts = zip(*(words[i:] for i in range(shingle)))
    h = np.fromiter((h64(s, seed) for s in map(b" ".join, parts)), dtype="<u8", count=len(words) - shingle + 1)
    n = len(h)
    if n < 2048:
        ones = np.unpackbits(h.view(np.uint8).reshape(n, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    else:
        octets = h.view(np.uint8).reshape(n, 8)
        table = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
        ones = np.concatenate([np.bincount(octets[:, i], minlength=256) @ table for i in range(8)])
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, text_hash, fp) of every whole text; ``fp`` is the fingerprint
    as a signed long."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                      F.xxhash64("text").alias("text_hash"))

    def kernel(b):
        fp = np.array([fingerprint(t, shingle) for t in C.raw_texts(b)], dtype=np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_hash"), pa.array(fp)],
                                          names=["doc_id", "text_hash", "fp"])

    return C.map_batches(src, kernel, "doc_id long, text_hash long, fp long")


def covering_masks(radius: int) -> list[int]:
    """The 2^(radius+1) - 1 masks; bit position i has vector 1 + i mod that
    many, so all nonzero vectors are used evenly."""
    n = (1 << (radius + 1)) - 1
    vectors = [1 + i % n for i in range(BITS)]
    return [sum(1 << i for i, m in enumerate(vectors) if bin(m & v).count("1") & 1) for v in range(1, n + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def forest(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links among distinct fingerprints."""
    x = fps.view(np.uint64)
    left = np.ones(len(x), dtype=bool)
    edges: list[tuple[int, int]] = []
    for root in range(len(x)):
        if not left[root]:
            continue
        left[root] = False
        queue = [root]
        while queue:
            i = queue.pop()
            near = np.flatnonzero(left & (np.bitwise_count(x ^ x[i]) <= radius))
            left[near] = False
            edges += [(int(fps[i]), int(fps[j])) for j in near]
            queue += near.tolist()
    return edges


def _ball_edges(fps: DataFrame) -> DataFrame:
    """Links at radius 2 without pairs: (fp, smallest fp at a point of its ball)."""
    points = F.concat(F.array(F.lit(0).cast("long")), F.array(*[F.lit(_signed(1 << i)) for i in range(BITS)]))
    ball = fps.select("fp", F.explode(points).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("z"))
    low = ball.groupBy("z").agg(F.min("fp").alias("a"), F.max("fp").alias("_top")).where("a != _top").select("z", "a")
    return ball.join(low, "z").where("fp != a").select("a", F.col("fp").alias("b")).distinct()


def links(distinct_fps: DataFrame, radius: int = 2, cap: int = 1000) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column ``fp``, no repeats)
    with the same components as all links of at most ``radius`` bits."""
    masks = covering_masks(radius)
    keyed = distinct_fps.select("fp", F.posexplode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("t", "mask"))
    keyed = keyed.select("fp", "t", F.col("fp").bitwiseAND(F.col("mask")).alias("key"))
    sizes = keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = materialize(keyed.join(sizes, ["t", "key"]), "buckets")

    def within(batches):
        for b in batches:
            out = [e for x in b.column("fps").to_pylist() for e in forest(np.array(sorted(x), dtype=np.int64), radius)]
            yield pa.RecordBatch.from_arrays([pa.array([e[i] for e in out], pa.int64()) for i in (0, 1)], names=["a", "b"])

    small = (members.where(F.col("n") <= cap).groupBy("t", "key").agg(F.collect_list("fp").alias("fps"))
             .select("fps"))
    small = C.map_arrow(small, within, "a long, b long")
    large = members.where(F.col("n") > cap).select("fp").distinct()
    if radius == 2:
        return small.unionByName(_ball_edges(large))
    if not large.isEmpty():
        raise ValueError("buckets above cap are only split for radius 2; raise cap")
    return small


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2, cap: int = 1000) -> DataFrame:
    """(doc_id, text_hash, fp, component, component_id): the smallest
    fingerprint and the smallest doc_id that each row reaches over links of at
    most ``radius`` differing bits. Only ``component`` tells components apart:
    ids may be null or repeated."""
    rows = materialize(fingerprints(docs, shingle), "fingerprints")
    distinct = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct")
    comp = components(links(distinct.select("fp"), radius, cap)).withColumnRenamed("node", "fp")
    # the id of a component is the smallest of its members' ids
    joined = distinct.join(comp, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    lowest = joined.groupBy("component").agg(F.min("low").alias("component_id"))
    of_fp = joined.join(lowest, "component").select("fp", "component", "component_id")
    return rows.join(of_fp, "fp")


def one_per_group(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """One document of each component: the row of its smallest id, null
    last (of several rows with that id, that of the smallest text hash; exact repeats
    of it once). Columns are those of ``docs``."""
    near = near_duplicates(docs, shingle, radius)
    chosen = near.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")).alias("x")).select(
        F.col("x.doc_id").alias("_id"), F.col("x.text_hash").alias("_hash"))
    src, own = C.private(docs)
    src = src.withColumn("_i", F.col(own["doc_id"]).cast("long")).withColumn("_h", F.xxhash64(own["text"]))
    on = [src["_i"].eqNullSafe(chosen["_id"]), src["_h"] == chosen["_hash"]]
    return C.public(src.join(chosen, on, "left_semi").dropDuplicates(["_i", "_h"]), own)

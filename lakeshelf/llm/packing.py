"""Best-fit packing of documents into fixed-length sequences by a grouping
genetic algorithm.

Texts become token ids (end id appended); only documents longer than a
sequence are cut, into full pieces after a first piece that takes the rest.
Full pieces are sequences of their own. The others are dealt by hash into
blocks of about ``block_items``; for each block several islands evolve
packings whose genes are whole bins: crossover injects well-filled bins of one
parent, drops the other parent's bins that repeat an item, and best-fits the
displaced items; mutation dissolves the emptiest bins. Between epochs each
island's elite migrates to the next island of its block. After the last epoch
the best island's bins are final, but those filled badly are dissolved and
their items packed once more in new blocks over all of them.

A block's work is bounded whatever the corpus, blocks are dealt evenly, and
each epoch is a written table, so a lost executor costs one epoch of a block.

Defined cases: a null or empty text is one piece of the end id alone; repeated
rows are packed as different documents; an empty table gives no pieces."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import common as C
from . import tokens as T

CAPACITY = 1024


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """(item, doc_id, piece, start, length, ids): ``ids`` are little-endian
    unsigned 32-bit integers. ``item`` numbers pieces once this is written."""
    sc = docs.sparkSession.sparkContext
    definition = sc.broadcast(T.load(tokenizer))
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def run(batches):
        enc, number = T.encoder(definition.value), C.task_rows()
        for b in C.chunks(batches):
            flat, at = enc.encode(b.column("text"))
            n = np.diff(at)
            count = -(-n // capacity)
            doc = np.repeat(np.arange(len(n)), count)
            first = np.cumsum(count) - count
            piece = np.arange(len(doc)) - first[doc]
            rest = n - (count - 1) * capacity  # length of the first piece
            start = np.where(piece == 0, 0, rest[doc] + (piece - 1) * capacity)
            length = np.where(piece == 0, rest[doc], capacity)
            raw = flat.astype("<u4").tobytes()
            begin = (at[:-1][doc] + start) * 4
            item = number(len(doc)) + np.arange(len(doc))
            yield pa.RecordBatch.from_arrays(
                [pa.array(item), b.column("doc_id").take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start),
                 pa.array(length), pa.array([raw[i:j] for i, j in zip(begin.tolist(), (begin + 4 * length).tolist())], pa.binary())],
                names=["item", "doc_id", "piece", "start", "length", "ids"])

    return C.map_arrow(src, run, "item long, doc_id long, piece int, start long, length long, ids binary")


class Packing:
    """Bins as lists of item numbers, with their fills."""

    def __init__(self, sizes: list[int], capacity: int):
        self.sizes, self.capacity = sizes, capacity
        self.bins: list[list[int]] = []
        self.fills: list[int] = []

    def copy_of(self, bins: list[list[int]], fills: list[int]) -> Packing:
        p = Packing(self.sizes, self.capacity)
        p.bins, p.fills = bins, fills
        return p

    def best_fit(self, items: list[int]) -> Packing:
        """Puts items, in the order given, into the fullest bin that holds
        them; a bit mask of the gaps in use finds it without a search. Bins
        are replaced, never changed, as packings share them."""
        gaps: list[list[int]] = [[] for _ in range(self.capacity + 1)]
        mask = 0
        for i, f in enumerate(self.fills):
            g = self.capacity - f
            if g:
                gaps[g].append(i)
                mask |= 1 << g
        own: set[int] = set()
        for x in items:
            s = self.sizes[x]
            above = mask >> s
            if above:
                g = s + (above & -above).bit_length() - 1
                i = gaps[g].pop()
                if not gaps[g]:
                    mask ^= 1 << g
                if i in own:
                    self.bins[i].append(x)
                else:
                    self.bins[i] = [*self.bins[i], x]
                    own.add(i)
                self.fills[i] += s
                g -= s
            else:
                i, g = len(self.bins), self.capacity - s
                self.bins.append([x])
                own.add(i)
                self.fills.append(s)
            if g:
                gaps[g].append(i)
                mask |= 1 << g
        return self

    def fitness(self) -> tuple[int, int]:
        """Fewer bins first, then fuller bins."""
        return -len(self.bins), sum(f * f for f in self.fills)


def crossover(a: Packing, b: Packing, rng: random.Random, fill: float = 0.995) -> Packing:
    """Half of b's well-filled bins, a's bins without their items, and the
    displaced items by best fit."""
    good = [i for i, f in enumerate(b.fills) if f >= fill * b.capacity]
    if not good:
        good = sorted(range(len(b.fills)), key=lambda i: -b.fills[i])[:max(1, len(b.fills) // 4)]
    taken = rng.sample(good, max(1, len(good) // 2))
    seen = bytearray(len(a.sizes))
    for i in taken:
        for x in b.bins[i]:
            seen[x] = 1
    bins, fills, loose = [b.bins[i] for i in taken], [b.fills[i] for i in taken], []
    for i, items in enumerate(a.bins):
        if any(seen[x] for x in items):
            loose += [x for x in items if not seen[x]]
        else:
            bins.append(items)
            fills.append(a.fills[i])
    loose.sort(key=lambda x: -a.sizes[x])
    return a.copy_of(bins, fills).best_fit(loose)


def mutate(p: Packing, rng: random.Random, share: float = 0.06) -> Packing:
    """Dissolves the emptiest bins and some others; best fit, nearly in
    descending order."""
    k = max(2, int(share * len(p.bins)))
    out = set(sorted(range(len(p.bins)), key=lambda i: p.fills[i])[:k])
    out.update(rng.sample(range(len(p.bins)), min(k, len(p.bins))))
    loose = [x for i in out for x in p.bins[i]]
    loose.sort(key=lambda x: -p.sizes[x] * (1 + 0.05 * rng.random()))
    keep = [i for i in range(len(p.bins)) if i not in out]
    return p.copy_of([p.bins[i] for i in keep], [p.fills[i] for i in keep]).best_fit(loose)


def from_bins(sizes: list[int], bin_of: list[int], capacity: int) -> Packing:
    p = Packing(sizes, capacity)
    where: dict[int, int] = {}
    for x, b in enumerate(bin_of):
        i = where.setdefault(b, len(p.bins))
        if i == len(p.bins):
            p.bins.append([])
            p.fills.append(0)
        p.bins[i].append(x)
        p.fills[i] += sizes[x]
    return p


def evolve(sizes: list[int], guests: list[Packing], seed: int, capacity: int = CAPACITY,
           population: int = 4, generations: int = 5) -> Packing:
    """One epoch of one island: the best of its population, which starts from
    the guests, descending best fit and shuffled best fit."""
    rng = random.Random(seed)
    down = sorted(range(len(sizes)), key=lambda x: -sizes[x])
    pop = list(guests)
    while len(pop) < population:
        order = down if not pop else sorted(down, key=lambda x: -sizes[x] * (1 + 0.1 * rng.random()))
        pop.append(Packing(sizes, capacity).best_fit(list(order)))
    bound = -(-sum(sizes) // capacity)
    for _ in range(generations):
        pop.sort(key=Packing.fitness, reverse=True)
        if len(pop[0].bins) <= bound:
            break
        a, b = pop[0], pop[1 + rng.randrange(len(pop) - 1)]
        child = crossover(a, b, rng) if rng.random() < 0.7 else crossover(b, a, rng)
        pop[-1] = max(child, mutate(child, rng), key=Packing.fitness)
    return max(pop, key=Packing.fitness)


_STATE = "block long, island int, items array<long>, sizes array<int>, bins array<int>"


def _epoch(state: DataFrame, guest: bool, round_seed: int, capacity: int) -> DataFrame:
    """Evolves every (block, island) row; with ``guest``, a second packing."""

    def run(batches):
        for b in batches:
            rows = b.to_pylist()
            for r in rows:
                sizes = r["sizes"]
                start = [from_bins(sizes, r[c], capacity) for c in ("bins", *(["guest"] if guest else [])) if r[c] is not None]
                best = evolve(sizes, start, (r["block"] * 1_000_003 + r["island"]) * 101 + round_seed, capacity)
                bins = [0] * len(sizes)
                for i, items in enumerate(best.bins):
                    for x in items:
                        bins[x] = i
                yield pa.RecordBatch.from_pylist([{k: r[k] for k in ("block", "island", "items", "sizes")} | {"bins": bins}], schema=_schema())

    return C.map_arrow(state, run, _STATE)


def _schema() -> pa.Schema:
    return pa.schema([("block", pa.int64()), ("island", pa.int32()), ("items", pa.list_(pa.int64())),
                      ("sizes", pa.list_(pa.int32())), ("bins", pa.list_(pa.int32()))])


def _evolved(items: DataFrame, count: int, salt: int, capacity: int, block_items: int, islands: int, epochs: int) -> DataFrame:
    """(item, length, sequence_id, offset, fill) of items packed in blocks; a
    sequence's id is its smallest item."""
    blocks = max(1, round(count / block_items))
    dealt = items.select("item", F.col("length").cast("int").alias("length"),
                         F.pmod(F.xxhash64("item", F.lit(salt)), F.lit(blocks)).alias("block"))
    grouped = dealt.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("item", "length"))).alias("x"))
    state = grouped.select("block", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"),
                           F.col("x.item").alias("items"), F.col("x.length").alias("sizes"), F.lit(None).cast("array<int>").alias("bins"))
    spread = lambda df: df.repartition(max(1, blocks * islands), "block", "island")  # noqa: E731  rows are heavy: about one in each task
    state = materialize(_epoch(spread(state), False, salt, capacity), "epoch")
    for e in range(1, epochs):
        elite = state.select("block", ((F.col("island") + 1) % islands).alias("island"), F.col("bins").alias("guest"))
        state = materialize(_epoch(spread(state.join(elite, ["block", "island"])), True, salt + e, capacity), "epoch")

    def places(batches):
        for b in batches:
            for r in b.to_pylist():
                sizes = np.array(r["sizes"], dtype=np.int64)
                bins, ids = np.array(r["bins"], dtype=np.int64), np.array(r["items"], dtype=np.int64)
                order = np.argsort(bins, kind="stable")
                s, f = sizes[order], bins[order]
                first = np.r_[True, f[1:] != f[:-1]] if len(f) else np.zeros(0, bool)
                run_of = np.cumsum(first) - 1
                before = np.cumsum(s) - s
                offset = before - before[first][run_of]
                fill = np.add.reduceat(s, np.flatnonzero(first))[run_of] if len(f) else s
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[order]), pa.array(s), pa.array(ids[order][first][run_of]), pa.array(offset), pa.array(fill)],
                    names=["item", "length", "sequence_id", "offset", "fill"])

    n = F.size(F.array_distinct("bins"))
    best = state.withColumn("score", F.struct((-n).alias("n"), (-F.col("island")).alias("i"))).groupBy("block").agg(
        F.max_by(F.struct("items", "sizes", "bins"), "score").alias("b")).select("b.*")
    return C.map_arrow(best.repartition(blocks), places, "item long, length long, sequence_id long, offset long, fill long")


def place(items: DataFrame, capacity: int = CAPACITY, block_items: int = 8192, islands: int = 3, epochs: int = 2,
          fill: float = 0.97) -> DataFrame:
    """(item, sequence_id, offset) for ``items`` (item, length), a written
    table with unique items and lengths of 1 to ``capacity``."""
    full = items.where(F.col("length") >= capacity).select("item", F.col("item").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    loose = items.where(F.col("length") < capacity)
    count = loose.count()
    if not count:
        return full
    packed = materialize(_evolved(loose, count, 1, capacity, block_items, islands, epochs), "packed")
    good = packed
    if count > 1.5 * block_items:
        poor = packed.where(F.col("fill") < fill * capacity)
        left = poor.count()
        if left:
            good = packed.where(F.col("fill") >= fill * capacity).unionByName(
                materialize(_evolved(poor.select("item", "length"), left, 2, capacity, block_items, islands, epochs), "packed"))
    return full.unionByName(good.select("item", "sequence_id", "offset"))


def pack(written_pieces: DataFrame, **kw) -> DataFrame:
    """A written table of pieces with ``sequence_id`` and ``offset`` added."""
    return written_pieces.join(place(written_pieces.select("item", "length"), **kw), "item")


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with ids and their place: doc_id, piece, start,
    length, ids, sequence_id, offset."""
    return pack(materialize(pieces(docs, tokenizer, capacity), "pieces"), capacity=capacity).drop("item")

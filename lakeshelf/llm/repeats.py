"""Repeated byte strings by suffix order and longest-previous-factor arrays.

A byte is repeated if a string of ``min_len`` bytes that covers it also starts
elsewhere, in any document. One suffix array of a whole corpus cannot be
built in a task, so suffixes are brought together by anchors:

1. Each window of ``min_len`` bytes has an anchor, the position of its
   smallest 32-byte gram hash (ties all count). Equal windows have equal
   anchors at equal places, so windows only need comparing around anchors of
   equal hash. An anchor's context is all bytes of the windows that hold it.
   Anchors whose hash occurs once are done; the counts are grouped sums.
2. Contexts that are equal as a whole are repeated as a whole. Only where
   different contexts meet at an anchor and some context is single are bytes
   compared, one copy of each context.
3. Contexts of an anchor hash go to one block. Their windows are split by what
   they must have in common: half of the offsets share the bytes left of the
   anchor, half those right of it, and so on down; halves that agree as a
   whole are settled, single ones are dropped. The suffixes that are left are
   sorted by prefix doubling, and previous and next smaller positions in
   suffix order give each suffix's earlier (and later) match. An anchor's
   repeated windows cover one interval, as all of them hold it.
4. More than ``cap`` different contexts at one anchor are halved in this way
   by Spark first, until groups fit. No pairs are made.

Positions are ordered by (doc_id, text hash, place); ``keep_first`` removes
only bytes with an earlier match, so that the first copy stays; otherwise
every copy goes.

Defined cases: a null text is empty; texts shorter than ``min_len`` have
nothing repeated; rows that repeat an id and text are copies of each other (with
``keep_first`` one document, each row of which keeps the same); matches never
cross documents and are judged on the input; an empty table gives no rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import common as C

GRAM = 32
#: Odd 64-bit multipliers for the eight-byte words of a gram.
_MUL = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93))


def gram_hashes(buf: bytes) -> np.ndarray:
    """Hash of the 32 bytes at every place."""
    n = len(buf) - GRAM + 1
    words = np.empty((len(buf) // 8 + 2) * 8, dtype=np.uint64)
    pad = buf + bytes(24)
    for k in range(8):
        v = np.frombuffer(pad, dtype="<u8", offset=k, count=(len(pad) - k) // 8)
        part = words[k::8]
        part[:min(len(v), len(part))] = v[:len(part)]
    h = words[:n] * _MUL[0]
    for i in (1, 2, 3):
        h += words[8 * i:n + 8 * i] * _MUL[i]
    h ^= h >> np.uint64(29)
    h *= _MUL[1]
    h ^= h >> np.uint64(32)
    return h


def _slide(f, x: np.ndarray, width: int) -> np.ndarray:
    """f over every run of ``width`` values, by doubling."""
    k, y = 1, x
    while 2 * k <= width:
        y = f(y[:-k], y[k:])
        k *= 2
    return y if k == width else f(y[:len(y) - (width - k)], y[width - k:])


def anchors(buf: bytes, min_len: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, their gram hashes) that are smallest in a window of
    ``min_len`` bytes of ``buf`` (at least as long)."""
    width = min_len - GRAM + 1
    h = gram_hashes(buf)
    low = np.zeros(len(h) + width - 1, dtype=np.uint64)
    low[width - 1:len(h)] = _slide(np.minimum, h, width)
    at = np.flatnonzero(_slide(np.maximum, low, width) == h)
    return at, h[at]


def text_anchors(texts: list[bytes], min_len: int):
    """Per text its anchors as (index, places, hashes, lefts, context hashes);
    short texts are put together, as the kernel works best on long arrays."""
    group: list[int] = []
    size = 0
    for i, t in enumerate(texts):
        if len(t) >= min_len:
            group.append(i)
            size += len(t)
        if size >= 1 << 18:
            yield from _group_anchors(texts, group, min_len)
            group, size = [], 0
    if group:
        yield from _group_anchors(texts, group, min_len)


def _group_anchors(texts, group, min_len):
    left = min_len - GRAM
    buf = b"".join(texts[i] for i in group)
    at, h = anchors(buf, min_len)
    ends = np.cumsum([len(texts[i]) for i in group])
    begins = np.concatenate([[0], ends[:-1]])
    doc = np.searchsorted(ends, at, side="right")
    inside = at + GRAM <= ends[doc]  # grams over two texts are nobody's
    at, h, doc = at[inside], h[inside].view(np.int64).tolist(), doc[inside]
    lo = np.maximum(begins[doc], at - left).tolist()
    hi = np.minimum(ends[doc], at + min_len).tolist()
    places = at.tolist()
    ctx = [xxhash.xxh3_64_intdigest(buf[a:b], p - a) - (1 << 63) for a, b, p in zip(lo, hi, places)]
    bounds = np.searchsorted(doc, np.arange(len(group) + 1)).tolist()
    for k, i in enumerate(group):
        a, b, base = bounds[k], bounds[k + 1], int(begins[k])
        yield i, [p - base for p in places[a:b]], h[a:b], ctx[a:b]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            if e > out[-1][1]:
                out[-1] = (out[-1][0], e)
        else:
            out.append((s, e))
    return out


# --- suffix order -----------------------------------------------------------

def suffix_ranks(block: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """Rank of the ``depth`` bytes at each start, equal for equal strings, in
    suffix order: words of up to eight bytes, then prefix doubling."""
    pad = np.concatenate([block, np.zeros(8, dtype=np.uint8)])
    n = len(block)
    key = np.zeros(n, dtype=np.uint64)
    have = min(8, depth)
    for i in range(have):
        key = key << np.uint64(8) | pad[i:n + i].astype(np.uint64)
    while True:
        rank = np.unique(key, return_inverse=True)[1].astype(np.int64)
        step = min(have, depth - have)
        if step <= 0:
            return rank[starts]
        last = 2 * have >= depth
        at = starts if last else np.arange(n)
        second = rank[np.minimum(at + step, n - 1)]
        key = rank[at] * (n + 1) + second
        if last:
            return np.unique(key, return_inverse=True)[1].astype(np.int64)
        have *= 2


def earlier_and_later(rank: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a suffix has an equal one at a smaller / larger ``order``. In
    suffix order (equal ranks stand together) the previous or next smaller
    position of a suffix is its earlier match if it lies in the same run of
    ranks; taken with the order reversed it is the later match."""
    by = np.lexsort((order, rank))
    r = rank[by]
    same = np.concatenate([[False], r[1:] == r[:-1]])  # sorted by position within a run: the one before is smaller
    prev, nxt = np.zeros(len(by), bool), np.zeros(len(by), bool)
    prev[by] = same
    nxt[by] = np.concatenate([same[1:], [False]])
    return prev, nxt


#: Offsets are halved within a block until a node has at most this many, so
#: that only these have to be sorted.
NODE = 24


class _Found:
    """Smallest and largest offset with any / an earlier match, per context."""

    def __init__(self, n: int):
        self.low, self.high, self.low1, self.high1 = [1 << 30] * n, [-1] * n, [1 << 30] * n, [-1] * n

    def add(self, i: int, lo: int, hi: int, earlier: bool) -> None:
        self.low[i], self.high[i] = min(self.low[i], lo), max(self.high[i], hi)
        if earlier:
            self.low1[i], self.high1[i] = min(self.low1[i], lo), max(self.high1[i], hi)


def _halved(rows: list[dict], nodes: list[tuple], found: _Found, min_len: int) -> list[tuple]:
    """One level of halving: nodes (context, group, a, b) of equal group
    compare their windows with offsets a to b. Halves that agree as a whole
    are found; the rest is returned, one node for each different half, without
    halves that share their common bytes with no other."""
    cores: dict[tuple, dict[tuple, list[tuple]]] = {}
    for i, g, a, b in nodes:
        ctx, left = rows[i]["ctx"], rows[i]["left"]
        short, mid = min_len - (len(ctx) - left), (a + b) // 2
        for a2, b2 in ((a, mid), (mid + 1, b)):
            lo, hi = max(a2, short), min(b2, left)
            if lo <= hi:
                core = ctx[left - a2:left + min_len - b2]
                part = (ctx[left - hi:left + min_len - lo], hi)
                cores.setdefault((g, a2, core), {}).setdefault(part, []).append((i, lo, hi, a2, b2))
    out = []
    for number, parts in enumerate(cores.values()):
        for same in parts.values():
            if len(same) > 1:  # in position order, so all but the first have an earlier match
                for k, (i, lo, hi, _, _) in enumerate(same):
                    found.add(i, lo, hi, k > 0)
            if len(parts) > 1:
                i, _, _, a2, b2 = same[0]
                out.append((i, number, a2, b2))
    out.sort()
    return out


def block_intervals(rows: list[dict], min_len: int) -> list[tuple[int, int, int, int]]:
    """Per context (g, ctx, left, a, b; rows in position order) the smallest
    and largest offset of its windows with any match, and with an earlier one;
    -1 if none. Offsets a to b are looked at: a window with offset o starts o
    bytes before the anchor. Only windows of one group and offset are
    compared: equal ones meet there, and a place does not meet itself in the
    overlapping context of another anchor."""
    found = _Found(len(rows))
    nodes = [(i, r["g"], r["a"], r["b"]) for i, r in enumerate(rows)]
    while nodes and max(b - a for _, _, a, b in nodes) > NODE:
        nodes = _halved(rows, nodes, found, min_len)
    by_width: dict[int, list[tuple]] = {}
    for x in nodes:
        by_width.setdefault(x[3] - x[2], []).append(x)
    for width, same in by_width.items():
        if width:  # a single offset is one string, and different ones were kept
            _sorted_matches(rows, same, width, found, min_len)
    return [(-1, -1, -1, -1) if h < 0 else (lo, h, -1 if h1 < 0 else lo1, h1)
            for lo, h, lo1, h1 in zip(found.low, found.high, found.low1, found.high1)]


def _sorted_matches(rows: list[dict], nodes: list[tuple], width: int, found: _Found, min_len: int) -> None:
    """Matches within nodes of ``width`` + 1 offsets, by suffix order. The
    bytes that all windows of a node share are equal in its group and left
    out: what remains of a window is ``width`` bytes, which start at the
    largest offset less its own."""
    texts, starts, owner, offsets, groups = [], [], [], [], []
    number: dict[tuple, int] = {}
    base = 0
    for i, g, a, b in nodes:
        ctx, left = rows[i]["ctx"], rows[i]["left"]
        lo, hi = max(a, min_len - (len(ctx) - left)), min(b, left)
        if lo > hi:
            continue
        text = ctx[left - hi:left - a] + ctx[left + min_len - b:left + min_len - lo]
        o = np.arange(lo, hi + 1)
        texts.append(text)
        starts.append(base + hi - o)
        owner.append(np.full(len(o), i))
        offsets.append(o)
        groups.append(o + min_len * number.setdefault((g, a), len(number)))
        base += len(text)
    if not texts:
        return
    block = np.frombuffer(b"".join(texts), dtype=np.uint8)
    starts, owner, offsets, groups = map(np.concatenate, (starts, owner, offsets, groups))
    rank = suffix_ranks(block, starts, width)
    prev, nxt = earlier_and_later(groups * (int(rank.max()) + 1) + rank, owner)
    for k in np.flatnonzero(prev | nxt).tolist():
        found.add(int(owner[k]), int(offsets[k]), int(offsets[k]), bool(prev[k]))


# --- steps ------------------------------------------------------------------

def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, k, size, text): texts are told apart by hash and byte length."""
    t = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(t).alias("k"),
                       F.octet_length(t).alias("size"), t.alias("text"))


def anchor_counts(keyed: DataFrame, min_len: int) -> DataFrame:
    """(h, n, low, high): anchors of each hash, and the smallest and largest
    hash of their contexts; summed in each batch before the shuffle."""

    def run(batches):
        for b in C.chunks(batches):
            hs, cs = [], []
            for _, _, h, c in text_anchors(C.raw_texts(b), min_len):
                hs += h
                cs += c
            h, c = np.array(hs, dtype=np.int64), np.array(cs, dtype=np.int64)
            by = np.lexsort((c, h))
            h, c = h[by], c[by]
            first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
            last = np.concatenate([first[1:], [len(h)]]) - 1 if len(h) else first
            yield pa.RecordBatch.from_arrays([pa.array(h[first]), pa.array(last - first + 1), pa.array(c[first]), pa.array(c[last])],
                                             names=["h", "n", "low", "high"])

    counts = C.map_arrow(keyed.select("text"), run, "h long, n long, low long, high long")
    return counts.groupBy("h").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))


_SPANS = "array<struct<s: int, e: int>>"


def _span_arrays(rows: list) -> pa.Array:
    flat, offsets = [], [0]
    mask = []
    for r in rows:
        if r:
            flat += r
        offsets.append(len(flat))
        mask.append(r is None)
    values = pa.StructArray.from_arrays([pa.array([x[0] for x in flat], pa.int32()), pa.array([x[1] for x in flat], pa.int32())], names=["s", "e"])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values, mask=pa.array(mask, pa.bool_()))


def occurrences(keyed: DataFrame, min_len: int) -> DataFrame:
    """(doc_id, k, size, h, c, n, pos, spans, later): the anchors of every
    text, one row for equal contexts within a text; ``pos`` is the first
    place; if there are more, ``spans`` has what the contexts of all cover and
    ``later`` what those after the first cover."""
    left = min_len - GRAM

    def run(batches):
        for b in C.chunks(batches):
            texts = C.raw_texts(b)
            cols: list[list] = [[], [], [], [], [], [], []]
            for i, at, h, c in text_anchors(texts, min_len):
                groups: dict[tuple, list[int]] = {}
                for x in zip(h, c, at):
                    groups.setdefault(x[:2], []).append(x[2])
                size = len(texts[i])
                for (hh, cc), places in groups.items():
                    cols[0].append(i)
                    cols[1].append(hh)
                    cols[2].append(cc)
                    cols[3].append(len(places))
                    cols[4].append(places[0])
                    reach = [(max(0, p - left), min(size, p + min_len)) for p in places] if len(places) > 1 else None
                    cols[5].append(reach and merged(reach))
                    cols[6].append(reach and merged(reach[1:]))
            doc = pa.array(np.array(cols[0], dtype=np.int64))
            yield pa.RecordBatch.from_arrays(
                [*(b.column(x).take(doc) for x in ("doc_id", "k", "size")), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()),
                 pa.array(cols[3], pa.int32()), pa.array(cols[4], pa.int32()), _span_arrays(cols[5]), _span_arrays(cols[6])],
                names=["doc_id", "k", "size", "h", "c", "n", "pos", "spans", "later"])

    return C.map_arrow(keyed, run, f"doc_id long, k long, size int, h long, c long, n int, pos int, spans {_SPANS}, later {_SPANS}")


_CTX = "h long, c long, m long, left int, a int, b int, g long, doc_id long, k long, pos int, ctx binary"


def contexts(keyed: DataFrame, wanted: DataFrame, min_len: int) -> DataFrame:
    """Bytes of the wanted contexts (h, c, m, doc_id, k, size, pos), read from
    their documents. ``g`` is the group that is compared, the hash at first."""
    left = min_len - GRAM
    lists = wanted.groupBy("doc_id", "k", "size").agg(F.collect_list(F.struct("h", "c", "m", "pos")).alias("want"))
    at = [keyed["doc_id"].eqNullSafe(lists["doc_id"]), keyed["k"] == lists["k"], keyed["size"] == lists["size"]]
    src = keyed.join(lists, at).select(keyed["doc_id"], keyed["k"], "text", "want")

    def run(batches):
        for b in C.chunks(batches):
            out = []
            for doc, k, raw, want in zip(b.column("doc_id").to_pylist(), b.column("k").to_pylist(), C.raw_texts(b), b.column("want").to_pylist()):
                for w in want:
                    lo = max(0, w["pos"] - left)
                    out.append((w["h"], w["c"], w["m"], w["pos"] - lo, 0, left, w["h"], doc, k, w["pos"], raw[lo:w["pos"] + min_len]))
            yield _context_batch(out)

    return C.map_arrow(src, run, _CTX)


_CTX_TYPES = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
_CTX_NAMES = ["h", "c", "m", "left", "a", "b", "g", "doc_id", "k", "pos", "ctx"]


def _context_batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[]] * len(_CTX_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _CTX_TYPES)], names=_CTX_NAMES)


def compared(ctx: DataFrame, min_len: int, block_bytes: int = 1 << 20) -> DataFrame:
    """(h, c, low, high, low1, high1): offsets with any / an earlier match, of
    contexts that are compared within their group ``g``."""

    def settle(rows):
        # one row of each context: exact repeats of a row bring copies
        rows = list({(r["h"], r["c"], r["a"]): r for r in rows}.values())
        rows.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"], r["k"], r["pos"]))
        found = block_intervals(rows, min_len)
        keep = [(r["h"], r["c"], *f) for r, f in zip(rows, found) if f[1] >= 0]
        cols = list(zip(*keep)) if keep else [[]] * 6
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, [pa.int64()] * 2 + [pa.int32()] * 4)],
                                          names=["h", "c", "low", "high", "low1", "high1"])

    def run(batches):
        rows, size, group = [], 0, None
        for b in batches:
            for r in b.to_pylist():
                if r["g"] != group and size >= block_bytes:
                    yield settle(rows)
                    rows, size = [], 0
                group = r["g"]
                rows.append(r)
                size += len(r["ctx"])
        if rows:
            yield settle(rows)

    return C.map_arrow(ctx.repartition("g").sortWithinPartitions("g"), run,
                       "h long, c long, low int, high int, low1 int, high1 int")


def split(ctx: DataFrame, min_len: int) -> tuple[DataFrame, DataFrame]:
    """Halves the offsets of large groups. Returns (settled offsets as in
    ``compared``, contexts of the halves that are still to be compared, with
    their group sizes ``m``)."""

    def halves(batches):
        for b in batches:
            out = []
            for r in b.to_pylist():
                mid = (r["a"] + r["b"]) // 2
                n, left = len(r["ctx"]), r["left"]
                for a, z in ((r["a"], mid), (mid + 1, r["b"])):
                    lo, hi = max(a, min_len - (n - left)), min(z, left)
                    if lo > hi:
                        continue
                    core = r["ctx"][left - a:left + min_len - z]
                    part = r["ctx"][left - hi:left + min_len - lo]
                    g = xxhash.xxh3_64_intdigest(core, xxhash.xxh64_intdigest(f"{r['h']} {a} {z}")) - (1 << 63)
                    out.append((r["h"], r["c"], xxhash.xxh3_64_intdigest(part, hi) - (1 << 63), hi, a, z, g, r["doc_id"], r["k"], r["pos"], part))
            yield _context_batch(out)

    child = materialize(C.map_arrow(ctx, halves, _CTX), "halves")  # here m holds the hash of the half's bytes
    lo = F.lit(min_len) - (F.length("ctx") - F.col("left"))
    child = child.withColumn("lo", F.greatest("a", lo)).withColumn("hi", F.least("b", "left"))
    rows = child.dropDuplicates(["g", "m", "h", "c"])
    # both written, so that the joins read plain shuffles and a half that very many contexts share can be split
    same = materialize(rows.groupBy("g", "m").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("doc_id", "k", "pos")).alias("first")), "same")
    sizes = materialize(same.groupBy("g").agg(F.count(F.lit(1)).alias("parts")), "sizes")
    known = rows.join(same, ["g", "m"])
    first = (F.col("first.doc_id").eqNullSafe(F.col("doc_id"))) & (F.col("first.k") == F.col("k")) & (F.col("first.pos") == F.col("pos"))
    settled = known.where("copies > 1").select("h", "c", F.col("lo").alias("low"), F.col("hi").alias("high"),
                                          F.when(first, -1).otherwise(F.col("lo")).alias("low1"), F.when(first, -1).otherwise(F.col("hi")).alias("high1"))
    rest = known.where(first).join(sizes.where("parts > 1"), "g").select(
        "h", "c", F.col("parts").alias("m"), "left", "a", "b", "g", "doc_id", "k", "pos", "ctx")
    return materialize(settled, "settled"), materialize(rest, "halves")


def repeated_spans(docs: DataFrame, min_len: int = 200, keep_first: bool = False, cap: int = 8192) -> DataFrame:
    """(k, size, spans) of texts with repeated bytes; spans may overlap and
    reach over a text's ends. With ``keep_first`` there is a row for each
    (doc_id, k, size), as copies of a text differ."""
    left = min_len - GRAM
    keyed = _keyed(docs)
    long = keyed.where(F.col("size") >= min_len)
    often = materialize(anchor_counts(long, min_len).where("n > 1").select("h", (F.col("low") != F.col("high")).alias("mixed")), "often")
    found = materialize(occurrences(long, min_len).join(often, "h"), "occurrences")
    ctx = found.groupBy("h", "c").agg(F.sum("n").alias("total"), F.first("mixed").alias("mixed"),
                                      F.min(F.struct("doc_id", "k", "pos", "size")).alias("first"))
    ctx = materialize(ctx, "contexts")
    groups = ctx.where("mixed").groupBy("h").agg(F.count(F.lit(1)).alias("m"), F.min("total").alias("least"))
    # written, so that the join reads two plain shuffles and an anchor that
    # very many contexts share can be split
    groups = materialize(groups.where("m > 1" if keep_first else "m > 1 and least = 1").select("h", "m"), "groups")
    wanted = ctx.where("mixed").join(groups, "h").select("h", "c", "m", "first.doc_id", "first.k", "first.size", "first.pos")
    work = materialize(contexts(long, wanted, min_len), "context_bytes")
    settled = materialize(compared(work.where(F.col("m") <= cap), min_len), "settled")
    large = work.where(F.col("m") > cap)
    while not large.isEmpty():
        done, rest = split(large, min_len)
        settled = settled.unionByName(done)
        # a half with a single offset is one string: different parts cannot match
        rest = rest.where("a < b")
        settled = settled.unionByName(materialize(compared(rest.where(F.col("m") <= cap), min_len), "settled"))
        large = rest.where(F.col("m") > cap)
    none = lambda c: F.when(F.col(c) >= 0, F.col(c))
    intervals = settled.groupBy("h", "c").agg(*[f(none(c)).alias(c) for f, c in ((F.min, "low"), (F.max, "high"), (F.min, "low1"), (F.max, "high1"))])
    known = ctx.join(intervals, ["h", "c"], "left").select("h", "c", "total", "first", "low", "high", "low1", "high1")
    each = found.join(materialize(known, "known"), ["h", "c"])  # written, as above
    whole = F.array(F.struct((F.col("pos") - left).alias("s"), (F.col("pos") + min_len).alias("e")))
    part = lambda lo, hi: F.when(F.col(hi).isNotNull(), F.array(F.struct(
        (F.col("pos") - F.col(hi)).alias("s"), (F.col("pos") - F.col(lo) + min_len).alias("e"))))
    if keep_first:
        is_first = F.col("first.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("first.k") == F.col("k")) & (F.col("first.pos") == F.col("pos"))
        none_yet = F.array().cast(_SPANS)
        spans = F.when(is_first, F.concat(F.coalesce("later", none_yet), F.coalesce(part("low1", "high1"), none_yet))).otherwise(F.coalesce("spans", whole))
        key = ["doc_id", "k", "size"]
    else:
        spans = F.when(F.col("spans").isNotNull(), F.col("spans")).when(F.col("total") > 1, whole).otherwise(part("low", "high"))
        key = ["k", "size"]
    return each.select(*key, F.explode(spans).alias("x")).groupBy(*key).agg(F.collect_set("x").alias("spans"))


def cut(raw: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, list[tuple[int, int]]]:
    """(the text without the spans, the spans merged and clipped)."""
    runs = merged([(max(0, s), min(len(raw), e)) for s, e in spans if e > 0 and s < len(raw)])
    out, at = [], 0
    for s, e in runs:
        out.append(raw[at:s])
        at = e
    return b"".join([*out, raw[at:]]), runs


def remove_repeats(docs: DataFrame, min_len: int = 200, keep_first: bool = False, cap: int = 8192) -> DataFrame:
    """(doc_id, n_bytes, kept, spans): the bytes that stay and the removed
    runs of every document."""
    keyed = _keyed(docs)
    # written: a text that very many documents hold is one row here and can be split there
    spans = materialize(repeated_spans(docs, min_len, keep_first, cap), "spans")
    at = [keyed["k"] == spans["k"], keyed["size"] == spans["size"]]
    if keep_first:
        at.append(keyed["doc_id"].eqNullSafe(spans["doc_id"]))
    src = keyed.join(spans, at, "left").select(keyed["doc_id"], "text", "spans")

    def kernel(b):
        texts = C.raw_texts(b)
        found = [cut(t, [(x["s"], x["e"]) for x in s or ()]) for t, s in zip(texts, b.column("spans").to_pylist())]
        return pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array([f[0] for f in found], pa.binary()),
             _span_arrays([f[1] for f in found])], names=["doc_id", "n_bytes", "kept", "spans"])

    return C.map_batches(src, kernel, f"doc_id long, n_bytes long, kept binary, spans {_SPANS}")

"""Prefix trie of conversations in double-array shards.

A node stands for a distinct sequence of first turns. Equal conversations are
counted first, so a sequence that a third of all conversations share is one
row. The distinct sequences are range-partitioned and sorted, which makes each
shard a contiguous piece of the trie: within it, turns get dense ids and the
nodes are packed level by level into BASE and CHECK arrays (the child of node s
by turn c is BASE[s] + c, and is there if CHECK of it is s). Traversing the
arrays by all sequences at once gives the members of each node; CHECK read
backwards adds up the subtrees.

Only nodes on the first or last sequence of a shard can have members in
another one. These shared upper nodes (at most two sequences' worth for each
shard) are merged by the digest of their sequence: members and children
are added, and their subtrees' sums are what whole nodes brought plus what the
shared nodes below them bring. All other nodes are final in their shard.

The ids that end at a node are hashed in ascending order: joined in blocks of
1024 consecutive ids, then the blocks are streamed through SHA-256, so no list
of a node's ids is held anywhere.

Defined cases: a null role or text is empty, a null turn comes first, turns
with the same number come in order of role, then text (of its first 64
characters, then of its digest); rows without a conv_id belong to no
conversation; extra columns are ignored; an empty table gives no nodes. A
task holds one conversation's turns as 20 bytes each."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import common as C

#: Bytes of a turn in a sequence: 16 of a digest, 4 of the text's length.
TURN = 20
#: A shard is closed at about this many turns.
SHARD_TURNS = 1 << 16
ID_BITS = 10


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, head, size, digest): what orders and tells turns
    apart, without their texts."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
        F.substring(text, 1, 64).alias("head"), F.octet_length(text).alias("size"),
        F.substring(F.unhex(F.sha2(whole, 256)), 1, 16).alias("digest"))


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, path): each conversation's turns, TURN bytes each, in order."""
    rows = turns.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "head", "digest")
    return C.map_arrow(rows.select("conv_id", "digest", "size"), _paths, "conv_id long, path binary")


def rebuilt(turns: DataFrame) -> DataFrame:
    """Sequences rebuilt as the contract says: the first h turns of
    conversation c - c % 5, then c's own after its first h; h is
    crc32(decimal c) % 9. The five conversations that share a base are brought
    together, the base first, of which only eight turns are kept."""
    c = F.col("conv_id")
    rows = turns.withColumn("base", c - c % 5).withColumn("h", (F.crc32(c.cast("string").cast("binary")) % 9).cast("int"))
    rows = rows.repartition("base").sortWithinPartitions(
        "base", c != F.col("base"), "conv_id", F.asc_nulls_first("turn"), "role", "head", "digest")
    return C.map_arrow(rows.select("base", "conv_id", "h", "digest", "size"), _rebuilt_paths, "conv_id long, path binary")


def _turn_bytes(b) -> list[bytes]:
    sizes = [n.to_bytes(4, "big") for n in b.column("size").to_pylist()]
    return [d + n for d, n in zip(b.column("digest").to_pylist(), sizes)]


def _path_batch(ids: list, paths: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(paths, pa.binary())], names=["conv_id", "path"])


def _paths(batches):
    own, turns = None, []
    for b in batches:
        ids, paths = [], []
        for conv_id, t in zip(b.column("conv_id").to_pylist(), _turn_bytes(b)):
            if conv_id != own and turns:
                ids.append(own)
                paths.append(b"".join(turns))
                turns = []
            own = conv_id
            turns.append(t)
        yield _path_batch(ids, paths)
    if turns:
        yield _path_batch([own], [b"".join(turns)])


def _rebuilt_paths(batches):
    family = own = None
    head, turns, skip, rows = [], [], 0, 0
    for b in batches:
        ids, paths = [], []
        for base, conv_id, h, t in zip(b.column("base").to_pylist(), b.column("conv_id").to_pylist(), b.column("h").to_pylist(), _turn_bytes(b)):
            if conv_id != own or base != family:
                if own is not None:
                    ids.append(own)
                    paths.append(b"".join(turns))
                if base != family:
                    family, head = base, []
                own, skip, rows = conv_id, h, 0
                turns = [] if conv_id == base else head[:h]
            if conv_id == base:
                turns.append(t)
                if len(head) < 8:
                    head.append(t)
            elif rows >= skip:
                turns.append(t)
            rows += 1
        yield _path_batch(ids, paths)
    if own is not None:
        yield _path_batch([own], [b"".join(turns)])


def distinct_sequences(paths: DataFrame) -> DataFrame:
    """(path, n, low, ends): each distinct sequence with the number of its
    conversations, their smallest id, and the SHA-256 of their ids."""
    keyed = materialize(paths.withColumn("key", F.substring(F.unhex(F.sha2("path", 256)), 1, 16)), "paths")
    blocks = keyed.groupBy("key", F.shiftright("conv_id", ID_BITS).alias("block")).agg(
        F.sort_array(F.collect_list("conv_id")).alias("ids"))  # at most 1024 ids, as each conversation has one row
    text = blocks.select("key", "block", F.concat_ws(",", F.col("ids").cast("array<string>")).alias("text"),
                         F.size("ids").cast("long").alias("n"), F.element_at("ids", 1).alias("low"))
    ends = C.map_arrow(text.repartition("key").sortWithinPartitions("key", "block"), _hash_ids, "key binary, n long, low long, ends string")
    # ids are unique, so the path of the smallest one stands for all
    first = ends.join(keyed.select("conv_id", "path"), ends["low"] == keyed["conv_id"])
    return first.select("path", "n", "low", "ends")


def _hash_ids(batches):
    key, out, digest, n, low = None, [], None, 0, None
    for b in batches:
        for r in zip(*(b.column(c).to_pylist() for c in ("key", "text", "n", "low"))):
            if r[0] != key:
                if key is not None:
                    out.append((key, n, low, digest.hexdigest()))
                key, n, low, digest = r[0], 0, r[3], hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(r[1].encode())
            n += r[2]
        yield _ends_batch(out)
        out = []
    if key is not None:
        yield _ends_batch([(key, n, low, digest.hexdigest())])


def _ends_batch(rows: list) -> pa.RecordBatch:
    types = (pa.binary(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=["key", "n", "low", "ends"])


class DoubleArray:
    """A trie over sorted, distinct sequences of dense ids (1 .. ``alphabet``),
    packed level by level. Node 0 is the root; ``check`` is -1 where no node
    is. ``levels[d]`` holds the nodes of depth d in the order of their
    sequences."""

    def __init__(self, codes: list[np.ndarray], alphabet: int):
        self.alphabet = alphabet
        size = alphabet + 2 + sum(map(len, codes))
        self.base = np.zeros(size, dtype=np.int64)
        self.check = np.full(size, -1, dtype=np.int64)
        self.check[0] = 0
        self.free = alphabet + 1  # slots from here on are tried; a lone child's base is slot - code >= 0
        self.levels = [np.zeros(1, dtype=np.int64)]
        length = np.array([len(c) for c in codes], dtype=np.int64)
        start = np.cumsum(length) - length
        flat = np.concatenate([*codes, np.zeros(0, dtype=np.int64)])
        at = np.zeros(len(codes), dtype=np.int64)  # where each sequence is
        depth = 0
        while True:
            going = np.flatnonzero(length > depth)
            if not len(going):
                break
            parent, code = at[going], flat[start[going] + depth]
            new = np.ones(len(going), dtype=bool)
            new[1:] = (parent[1:] != parent[:-1]) | (code[1:] != code[:-1])
            edges = np.flatnonzero(new)
            node = self._place(parent[edges], code[edges])
            at[going] = node[np.cumsum(new) - 1]
            self.levels.append(node)
            depth += 1

    def _grow(self, n: int) -> None:
        if n >= len(self.check):
            more = max(n + 1 - len(self.check), len(self.check))
            self.base = np.concatenate([self.base, np.zeros(more, dtype=np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, dtype=np.int64)])

    def _place(self, parent: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Slots for one level's children (those of a node are neighbours)."""
        node = np.empty(len(parent), dtype=np.int64)
        first = np.flatnonzero(np.r_[True, parent[1:] != parent[:-1]])
        count = np.diff(np.r_[first, len(parent)])
        for i, n in zip(first[count > 1].tolist(), count[count > 1].tolist()):
            c = code[i:i + n]
            low, slot = int(c.min()), self.free
            span = int(c.max()) - low
            while True:
                self._grow(slot + span)
                if (self.check[slot + (c - low)] < 0).all():
                    break
                slot += 1
            node[i:i + n] = slot + (c - low)
            self.base[parent[i]] = slot - low
            self.check[node[i:i + n]] = parent[i]
            self._next_free()
        lone = first[count == 1]
        if len(lone):
            self._grow(self.free + len(lone))
            slots = np.flatnonzero(self.check[self.free:] < 0)[:len(lone)] + self.free
            while len(slots) < len(lone):
                self._grow(len(self.check))
                slots = np.flatnonzero(self.check[self.free:] < 0)[:len(lone)] + self.free
            node[lone] = slots
            self.base[parent[lone]] = slots - code[lone]
            self.check[slots] = parent[lone]
            self._next_free()
        return node

    def _next_free(self) -> None:
        while self.free < len(self.check) and self.check[self.free] >= 0:
            self.free += 1

    def step(self, nodes: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The child of each node by each id, -1 where there is none."""
        to = self.base[nodes] + codes
        inside = (to >= 0) & (to < len(self.check))
        to = np.where(inside, to, 0)
        return np.where(inside & (self.check[to] == nodes) & (to != 0), to, -1)


def _shard(paths: list[bytes], n: np.ndarray, low: np.ndarray, ends: list[str]):
    """Columns of one shard's nodes."""
    ids: dict[bytes, int] = {}
    size = [0]
    codes = []
    for p in paths:
        c = np.empty(len(p) // TURN, dtype=np.int64)
        for i in range(len(c)):
            t = p[i * TURN:(i + 1) * TURN]
            k = ids.setdefault(t, len(ids) + 1)
            if k == len(size):
                size.append(int.from_bytes(t[16:], "big"))
            c[i] = k
        codes.append(c)
    trie = DoubleArray(codes, len(ids))
    slots = len(trie.check)
    members, lowest = np.zeros(slots, dtype=np.int64), np.full(slots, np.iinfo(np.int64).max)
    depth, length = np.zeros(slots, dtype=np.int64), np.zeros(slots, dtype=np.int64)
    size = np.array(size, dtype=np.int64)
    # all sequences walk the arrays together
    long = np.array([len(c) for c in codes], dtype=np.int64)
    start, flat = np.cumsum(long) - long, np.concatenate([*codes, np.zeros(0, dtype=np.int64)])
    at, d = np.zeros(len(codes), dtype=np.int64), 0
    going = np.arange(len(codes))
    shared = np.zeros(slots, dtype=bool)
    key: dict[int, tuple[bytes, bytes | None]] = {}
    for i in {0, len(codes) - 1}:
        key[0] = (hashlib.sha256(b"").digest()[:16], None)
    shared[0] = True
    while True:
        np.add.at(members, at[going], n[going])
        np.minimum.at(lowest, at[going], low[going])
        going = going[long[going] > d]
        if not len(going):
            break
        c = flat[start[going] + d]
        before = at[going]
        at[going] = trie.step(before, c)
        length[at[going]] = size[c]
        d += 1
        depth[at[going]] = d
        for i in {0, len(codes) - 1}:  # the first and last sequence's nodes may go on in a neighbour
            if long[i] >= d and not shared[at[i]]:
                shared[at[i]] = True
                digest = lambda m: hashlib.sha256(paths[i][:m * TURN]).digest()[:16]
                key[int(at[i])] = (digest(d), digest(d - 1))
    end_of = dict(zip(at.tolist(), ends))
    nodes = np.concatenate(trie.levels)
    children = np.bincount(trie.check[nodes[1:]], minlength=slots)
    whole_children = np.bincount(trie.check[nodes[1:]][~shared[nodes[1:]]], minlength=slots)
    leaves = ((children == 0) & ~shared).astype(np.int64)
    saved = np.where(shared, 0, (members - 1) * length)
    for level in reversed(trie.levels[1:]):
        parent = trie.check[level]
        np.add.at(leaves, parent, leaves[level])
        np.add.at(saved, parent, saved[level])
    parent = trie.check[nodes]
    up = shared[parent] & (nodes != 0)
    listed = nodes.tolist()
    return {
        "conv_id": lowest[nodes], "depth": depth[nodes], "parent_conv_id": lowest[parent], "n_convs": members[nodes],
        "n_children": np.where(shared[nodes], whole_children[nodes], children[nodes]), "n_leaves": leaves[nodes], "saved_tokens": saved[nodes],
        "ends_sha256": [end_of.get(s) for s in listed], "shared": shared[nodes],
        "key": [key[s][0] if s in key else None for s in listed],
        "parent_key": [key[int(p)][0] if u else None for p, u in zip(parent.tolist(), up.tolist())],
        "own": np.where(nodes == 0, 0, length[nodes]),
    }


_NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
         "ends_sha256 string, shared boolean, key binary, parent_key binary, own long")
_ARROW = (pa.int64(),) * 7 + (pa.string(), pa.bool_(), pa.binary(), pa.binary(), pa.int64())


def _shards(batches, shard_turns: int):
    held, turns = [[], [], [], []], 0

    def flush():
        cols = _shard(held[0], np.array(held[1], dtype=np.int64), np.array(held[2], dtype=np.int64), held[3])
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(cols.values(), _ARROW)], names=list(cols))

    for b in batches:
        for row in zip(*(b.column(c).to_pylist() for c in ("path", "n", "low", "ends"))):
            for column, v in zip(held, row):
                column.append(v)
            turns += 1 + len(row[0]) // TURN
            if turns >= shard_turns:
                yield flush()
                held, turns = [[], [], [], []], 0
    if turns:
        yield flush()


def trie(paths: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row for each node: conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves (childless nodes below or
    at it), saved_tokens (bytes of last turns that further members repeat, over
    its subtree) and ends_sha256 of the ids that end there."""
    distinct = materialize(distinct_sequences(paths), "sequences")
    ranged = distinct.repartitionByRange("path").sortWithinPartitions("path")
    nodes = materialize(C.map_arrow(ranged, lambda batches: _shards(batches, shard_turns), _NODE), "nodes")
    whole, upper = nodes.where("NOT shared"), nodes.where("shared")
    merged = upper.groupBy("key").agg(
        F.first("parent_key", True).alias("parent_key"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"),
        F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("below"),
        F.sum("saved_tokens").alias("saved"), F.max("ends_sha256").alias("ends_sha256"), F.max("own").alias("own"))
    merged = materialize(merged, "upper")
    kids = merged.where(F.col("parent_key").isNotNull()).groupBy(F.col("parent_key").alias("key")).agg(F.count(F.lit(1)).alias("kids"))
    full = merged.join(kids, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("kids", F.lit(0))).drop("kids")
    full = materialize(full.withColumn("leaf", (F.col("n_children") == 0).cast("long"))
                       .withColumn("gain", (F.col("n_convs") - 1) * F.col("own")), "upper")
    total = _subtrees(full)
    low = full.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("up"))
    none = F.lit(hashlib.sha256(b"").hexdigest())
    columns = lambda df: df.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256"))
    top = full.join(total, "key").join(low, "parent_key", "left").withColumn("parent_conv_id", F.col("up"))
    below = whole.where(F.col("parent_key").isNotNull()).join(low, "parent_key").withColumn("parent_conv_id", F.col("up"))
    rest = whole.where(F.col("parent_key").isNull())
    return columns(top).unionByName(columns(below)).unionByName(columns(rest))


def _subtrees(upper: DataFrame) -> DataFrame:
    """(key, n_leaves, saved_tokens) of the shared nodes over their whole
    subtrees. What whole nodes bring to a shared node is already added up
    along its shard, so each shared node's own part (its leaf, its gain) goes
    to itself and all shared nodes above it: their chains are followed by
    doubling, one grouped sum and one join a round."""
    sums = materialize(upper.select("key", F.col("leaf").alias("l"), F.col("gain").alias("g"), F.col("parent_key").alias("jump")), "sums")
    while not sums.where(F.col("jump").isNotNull()).isEmpty():
        # what lies at a node and below it within 2^k steps goes on to the node 2^k steps up
        passed = sums.where(F.col("jump").isNotNull()).groupBy(F.col("jump").alias("key")).agg(F.sum("l").alias("l1"), F.sum("g").alias("g1"))
        onward = sums.select(F.col("key").alias("jump"), F.col("jump").alias("next"))
        sums = materialize(
            sums.join(passed, "key", "left").join(onward, "jump", "left")
            .select("key", (F.col("l") + F.coalesce("l1", F.lit(0))).alias("l"), (F.col("g") + F.coalesce("g1", F.lit(0))).alias("g"),
                    F.col("next").alias("jump")), "sums")
    return sums.join(upper, "key").select("key", (F.col("l") + F.col("below")).alias("n_leaves"), (F.col("g") + F.col("saved")).alias("saved_tokens"))

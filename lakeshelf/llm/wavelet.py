"""Token ids of documents in wavelet matrix files.

Documents are encoded, dealt to shards of consecutive doc_ids and sorted;
each shard's ids become one wavelet matrix: a bit plane for each of 16 id
bits, every plane stably partitioned by its bits for the next, with a sample
of ranks per 512 bits. A shard is one row of a Parquet file compressed with
zstandard: its documents' ids and lengths, planes, rank samples and zero
counts. So access, counting (rank) and occurrence lookup (select) of a token
need only that file.

Texts are range partitioned by doc_id; a partition closes a shard whenever it
holds enough ids, so long texts do not make large shards. A document's global
start is its shard's start (running sums over shards) plus its place there.

Defined cases: a null or empty text is the end id alone; null ids come first;
rows that share an id are ordered by their text's hash, exact repeats in any
order (they are equal); an empty table makes no shards."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checked_broadcast, scratch_path
from . import common as C
from . import tokens as T

PLANES = 16
BLOCK = 512


class Matrix:
    """A wavelet matrix over ids below 2^PLANES."""

    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int], ranks: list[np.ndarray]):
        self.n, self.planes, self.zeros, self.ranks = n, planes, zeros, ranks

    @classmethod
    def build(cls, ids: np.ndarray) -> Matrix:
        x = np.ascontiguousarray(ids, dtype=np.uint16)
        planes, zeros, ranks = [], [], []
        for k in range(PLANES - 1, -1, -1):
            bit = (x & np.uint16(1 << k)) != 0
            packed = np.packbits(bit)
            pad = np.zeros(-(-len(packed) // (BLOCK // 8)) * (BLOCK // 8), dtype=np.uint8)
            pad[:len(packed)] = packed
            ones = np.bitwise_count(pad.reshape(-1, BLOCK // 8)).sum(axis=1, dtype=np.int64)
            planes.append(packed)
            ranks.append((np.cumsum(ones) - ones).astype(np.int32))
            low = x[np.flatnonzero(~bit)]
            zeros.append(len(low))
            x = np.concatenate([low, x[np.flatnonzero(bit)]])
        return cls(len(ids), planes, zeros, ranks)

    def _ones(self, k: int, i: int) -> int:
        """Ones among the first i bits of plane k."""
        if i <= 0:
            return 0
        block = (i - 1) // BLOCK
        at = block * BLOCK
        part = self.planes[k][at // 8:-(-i // 8)].copy()
        if i % 8:
            part[-1] &= 0xFF << (8 - i % 8) & 0xFF
        return int(self.ranks[k][block]) + int(np.bitwise_count(part).sum())

    def _bit(self, k: int, i: int) -> int:
        return int(self.planes[k][i >> 3]) >> (7 - (i & 7)) & 1

    def access(self, i: int) -> int:
        """The id at place i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        out = 0
        for k in range(PLANES):
            b = self._bit(k, i)
            ones = self._ones(k, i)
            out = out << 1 | b
            i = self.zeros[k] + ones if b else i - ones
        return out

    def _narrow(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        for k in range(PLANES):
            a, b = self._ones(k, lo), self._ones(k, hi)
            if token >> (PLANES - 1 - k) & 1:
                lo, hi = self.zeros[k] + a, self.zeros[k] + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """How often a token occurs in places lo to hi (rank)."""
        a, b = self._narrow(token, lo, self.n if hi is None else hi)
        return b - a

    def occurrence(self, token: int, j: int) -> int:
        """Place of the token's j-th occurrence, from 0 (select); -1 if there
        are fewer."""
        lo, hi = self._narrow(token, 0, self.n)
        if j < 0 or lo + j >= hi:
            return -1
        i = lo + j
        for k in range(PLANES - 1, -1, -1):
            one = token >> (PLANES - 1 - k) & 1
            i = self._select(k, i - self.zeros[k] if one else i, one)
        return i

    def _select(self, k: int, j: int, one: int) -> int:
        """Place of the j-th one (or zero) of plane k."""
        starts = np.arange(len(self.ranks[k]), dtype=np.int64) * BLOCK
        before = self.ranks[k].astype(np.int64) if one else starts - self.ranks[k]
        block = int(np.searchsorted(before, j, side="right")) - 1
        bits = np.unpackbits(self.planes[k][block * BLOCK // 8:(block + 1) * BLOCK // 8])
        bits = bits[:self.n - block * BLOCK]
        return block * BLOCK + int(np.flatnonzero(bits == one)[j - int(before[block])])

    def decode(self) -> np.ndarray:
        """All ids, by undoing the partitions from the last plane up."""
        x = np.zeros(self.n, dtype=np.uint16)
        for k in range(PLANES - 1, -1, -1):
            bit = np.unpackbits(self.planes[k], count=self.n).view(bool)
            z = self.zeros[k]
            out = np.empty_like(x)
            out[np.flatnonzero(~bit)] = x[:z]
            out[np.flatnonzero(bit)] = x[z:] | np.uint16(1 << (PLANES - 1 - k))
            x = out
        return x


FILE_SCHEMA = ("part long, shard int, n long, doc_ids array<long>, lengths array<long>, zeros array<long>, "
               "planes array<binary>, ranks array<binary>")


def _row(part: int, shard: int, docs: list, lengths: list[int], ids: np.ndarray) -> pa.RecordBatch:
    m = Matrix.build(ids)
    return pa.RecordBatch.from_pydict({
        "part": [part], "shard": [shard], "n": [m.n], "doc_ids": [docs], "lengths": [lengths], "zeros": [m.zeros],
        "planes": [[x.tobytes() for x in m.planes]], "ranks": [[x.astype("<i4").tobytes() for x in m.ranks]]}, schema=_SCHEMA)


_SCHEMA = pa.schema([("part", pa.int64()), ("shard", pa.int32()), ("n", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                     ("lengths", pa.list_(pa.int64())), ("zeros", pa.list_(pa.int64())), ("planes", pa.list_(pa.binary())),
                     ("ranks", pa.list_(pa.binary()))])


def matrix_of(row: dict) -> Matrix:
    """The matrix in a file's row."""
    return Matrix(row["n"], [np.frombuffer(x, dtype=np.uint8) for x in row["planes"]], row["zeros"],
                  [np.frombuffer(x, dtype="<i4") for x in row["ranks"]])


def write(docs: DataFrame, path: str, tokenizer: str | None = None, shard_ids: int = 1 << 20) -> None:
    """Writes the documents' shards to ``path`` in ascending doc_id order: a
    range partition is read in order and closes a shard whenever it holds
    ``shard_ids`` ids, so memory is bounded whatever a partition holds."""
    definition = docs.sparkSession.sparkContext.broadcast(T.load(tokenizer))
    src = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("_h"))
           .repartitionByRange("doc_id", "_h").sortWithinPartitions("doc_id", "_h").select("doc_id", "text"))

    def run(batches):
        enc, part, shard = T.encoder(definition.value), C.task_rows()(0) >> 40, 0
        held, lengths, ids, total = [], [], [], 0
        for b in C.chunks(batches):
            flat, at = enc.encode(b.column("text"))
            if flat.max(initial=0) >> PLANES:
                raise ValueError(f"token ids must be below {1 << PLANES}")
            flat = flat.astype(np.uint16)
            for d, i, j in zip(b.column("doc_id").to_pylist(), at[:-1].tolist(), at[1:].tolist()):
                held.append(d)
                lengths.append(j - i)
                ids.append(flat[i:j])
                total += j - i
                if total >= shard_ids:
                    yield _row(part, shard, held, lengths, np.concatenate(ids))
                    shard, total = shard + 1, 0
                    held, lengths, ids = [], [], []
        if held:
            yield _row(part, shard, held, lengths, np.concatenate(ids))

    C.map_arrow(src, run, FILE_SCHEMA).write.mode("overwrite").option("compression", "zstd").parquet(path)


def read(spark, path: str) -> DataFrame:
    """The files' rows, one for each shard."""
    return spark.read.schema(FILE_SCHEMA).parquet(path)


def shard_starts(files: DataFrame) -> DataFrame:
    """(part, shard, shard_start): ids before each shard. Running sums are
    taken within the shards of a part and over the parts' totals."""
    sizes = files.select("part", "shard", "n")
    inner = Window.partitionBy("part").orderBy("shard")
    within = sizes.withColumn("before", F.sum("n").over(inner) - F.col("n"))
    totals = sizes.groupBy("part").agg(F.sum("n").alias("n"))
    base = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))  # a row for each writing task
    return within.join(base, "part").select("part", "shard", (F.col("base") + F.col("before")).alias("shard_start"))


def documents(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document, decoded from its
    shard's planes; ``ids`` are little-endian unsigned 32-bit integers."""

    def run(batches):
        for b in batches:
            for r in range(b.num_rows):
                row = b.slice(r, 1).to_pylist()[0]
                raw = matrix_of(row).decode().astype("<u4").tobytes()
                n = np.array(row["lengths"], dtype=np.int64)
                end = np.cumsum(n)
                start = end - n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), row["part"])), pa.array(np.full(len(n), row["shard"], dtype=np.int32)),
                     pa.array(row["doc_ids"], pa.int64()), pa.array(start), pa.array(n),
                     pa.array([raw[4 * i:4 * j] for i, j in zip(start.tolist(), end.tolist())], pa.binary())],
                    names=["part", "shard", "doc_id", "at", "n_tokens", "ids"])

    return C.map_arrow(files, run, "part long, shard int, doc_id long, at long, n_tokens long, ids binary")


def occurrences(files: DataFrame, token: int) -> DataFrame:
    """(part, shard, place): every place of a token, by select in each shard."""

    def run(batches):
        for b in batches:
            for r in range(b.num_rows):
                row = b.slice(r, 1).to_pylist()[0]
                m = matrix_of(row)
                at = [m.occurrence(token, j) for j in range(m.count(token))]
                yield pa.RecordBatch.from_arrays([pa.array([row["part"]] * len(at), pa.int64()), pa.array([row["shard"]] * len(at), pa.int32()),
                                                  pa.array(at, pa.int64())], names=["part", "shard", "place"])

    return C.map_arrow(files, run, "part long, shard int, place long")


def read_back(spark, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document in the files of
    ``path``; ``start`` counts the ids of all documents before it."""
    files = read(spark, path)
    return documents(files).join(checked_broadcast(shard_starts(files)), ["part", "shard"]).select(
        "doc_id", (F.col("shard_start") + F.col("at")).alias("start"), "n_tokens", "ids")


def round_trip(docs: DataFrame, path: str | None = None, tokenizer: str | None = None) -> DataFrame:
    """Writes the files and reads every document back from them."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "wavelet")
    write(docs, path, tokenizer)
    return read_back(spark, path)

"""Helpers shared by the text operators: Arrow batch access, ASCII word
splitting and the columns of the ``documents`` table.

Conventions of every operator here: a null text counts as empty; extra input
columns are ignored or carried, never confused with computed ones (operators
select the columns that they name); repeated rows each get a result row."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DOC_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: Rows of an Arrow batch are cut again so that a kernel holds at most about
#: this many text bytes at once (one longer text makes a batch of its own).
CHUNK_BYTES = 8 << 20


def q(name: str) -> str:
    """Column name quoted for ``F.col`` (names may hold dots)."""
    return "`" + name.replace("`", "``") + "`"


def ref(name: str):
    return F.col(q(name))


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """Strings of a column; null is empty."""
    return [t or "" for t in batch.column(name).to_pylist()]


def raw_texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """UTF-8 bytes of a column, without decoding; null is empty."""
    return [t or b"" for t in batch.column(name).cast(pa.binary()).to_pylist()]


def chunks(batches: Iterator[pa.RecordBatch], name: str = "text") -> Iterator[pa.RecordBatch]:
    """The batches, cut so that ``name`` has about CHUNK_BYTES in each."""
    for b in batches:
        if b.num_rows == 0:
            continue
        size = np.frombuffer(pa.compute.binary_length(b.column(name).cast(pa.large_binary()).fill_null(b"")).cast(pa.int64()).buffers()[1],
                             dtype=np.int64)[: b.num_rows]
        at, held = 0, 0
        for i, n in enumerate(size.tolist()):
            if held and held + n > CHUNK_BYTES:
                yield b.slice(at, i - at)
                at, held = i, 0
            held += n
        yield b.slice(at)


def task_rows() -> Callable[[int], int]:
    """Numbers rows uniquely over all tasks: call with a count, get the first
    of that many numbers (partition in the high bits). Only stable once the
    result has been written."""
    state = [TaskContext.get().partitionId() << 40]

    def take(n: int) -> int:
        state[0] += n
        return state[0] - n

    return take


def ship_code(spark) -> None:
    """Sends this package's code to the Python workers, once per context, so
    that executors need no copy of their own."""
    sc = spark.sparkContext
    if getattr(sc, "_llm_code_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="lakeshelf-code-"), "lakeshelf_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)
    sc._llm_code_shipped = True


def map_arrow(df: DataFrame, run, schema: str) -> DataFrame:
    """``df.mapInArrow`` with this package importable on the workers."""
    ship_code(df.sparkSession)
    return df.mapInArrow(run, schema)


def map_batches(df: DataFrame, kernel: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str,
                text: str = "text") -> DataFrame:
    """``df.mapInArrow`` with batches bounded in text bytes."""

    def run(batches):
        for b in chunks(batches, text):
            yield kernel(b)

    return map_arrow(df, run, schema)


def private(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The table with its columns renamed to ``_k0``, ``_k1`` ..., and the new
    name of each, so that no column of a caller clashes with a computed one."""
    own = {c: f"_k{i}" for i, c in enumerate(docs.columns)}
    return docs.select(*[ref(c).alias(k) for c, k in own.items()]), own


def public(df: DataFrame, own: dict[str, str]) -> DataFrame:
    """Only the caller's columns, under their names."""
    return df.select(*[F.col(k).alias(c) for c, k in own.items()])


def crc32_of_id(doc_id: str = "doc_id"):
    """Unsigned crc32 of the id's decimal text (null id: of the empty text)."""
    return F.crc32(F.coalesce(ref(doc_id).cast("string"), F.lit("")).cast("binary"))

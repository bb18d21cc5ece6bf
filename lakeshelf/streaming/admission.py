"""A stream source that admits at most a number of rows into a micro-batch and
can start at what is there now, over a folder (or file) of Parquet.

Its offsets are positions in the order of arrival: ``{"file": i, "row": r}``
means that all files before the i-th and the first r rows of the i-th are
read. Which file is the i-th is written to the ``progress`` folder before an
offset that needs it is handed out, and so is the end of each batch that Spark
plans; a restarted query goes on from there and reads no row twice or never.
Files must be complete when they become visible and must not change. A
progress folder belongs to one checkpoint.

One stream plans and writes a batch after the other, so a large backlog takes
a batch's time for each. :func:`read_lanes` gives several streams instead, each
over its own share of the rows of every file and each with that limit.
"""

from __future__ import annotations

import bisect
import itertools
import json
import sys
import uuid

import pyarrow as pa
from pyarrow import fs as pafs
from pyarrow import parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

FORMAT = "lakeshelf_admission"
#: Rows of a file that one task reads.
TASK_ROWS = 1 << 18
#: Bytes of a column that are read at once.
BUFFER = 1 << 20


def _files(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def _names(path: str) -> list[pafs.FileInfo]:
    """The files of a folder, or the file itself."""
    fs, p = _files(path)
    info = fs.get_file_info(p)
    if info.type == pafs.FileType.File:
        return [info]
    found = fs.get_file_info(pafs.FileSelector(p, recursive=True, allow_not_found=True))
    return [f for f in found if f.type == pafs.FileType.File and f.base_name[0] not in "._"]


def _put(folder: str, name: str, value) -> None:
    """Write a small file, complete under its name or not there."""
    fs, folder = _files(folder)
    fs.create_dir(folder, recursive=True)
    with fs.open_output_stream(f"{folder}/.{name}") as out:
        out.write(json.dumps(value).encode())
    fs.move(f"{folder}/.{name}", f"{folder}/{name}")


def _get(folder: str, name: str):
    fs, folder = _files(folder)
    with fs.open_input_stream(f"{folder}/{name}") as s:
        return json.loads(s.read())


def _checked(rows: int, start: str, lanes: int) -> None:
    if rows < 1 or lanes < 1 or start not in ("earliest", "latest"):
        raise ValueError("rows and lanes must be positive and start 'earliest' or 'latest'")


class Range(InputPartition):
    """Rows [first, last) of a file."""

    def __init__(self, path: str, first: int, last: int, lane: int = 0):
        self.path, self.first, self.last, self.lane = path, first, last, lane


class Place:
    """A worker's place in a file. Parquet is decoded from the start of a row
    group on, so the place is kept for the batch that goes on from there."""

    def __init__(self, file: pa.NativeFile, names: list[str]):
        self.file = pq.ParquetFile(file, buffer_size=BUFFER)  # a worker holds a place of each lane
        self.names = [n for n in names if n in self.file.schema_arrow.names]
        groups = self.file.metadata
        self.ends = list(itertools.accumulate(groups.row_group(g).num_rows for g in range(groups.num_row_groups)))
        self.row = self.end = 0  # the next row, and the end of its row group
        self.batches, self.rest = iter(()), None

    def _open(self, row: int) -> None:
        g = bisect.bisect_right(self.ends, row)
        self.row, self.end = self.ends[g - 1] if g else 0, self.ends[g]
        self.batches, self.rest = iter(self.file.iter_batches(8192, row_groups=[g], columns=self.names)), None

    def take(self, first: int, last: int):
        """Batches of the rows [first, last)."""
        while first < last:
            if not self.row <= first < self.end:
                self._open(first)
            b = next(self.batches) if self.rest is None else self.rest
            lo, hi = min(first - self.row, b.num_rows), min(last - self.row, b.num_rows)
            self.row += hi
            self.rest = b.slice(hi) if hi < b.num_rows else None
            if lo < hi:
                yield b.slice(lo, hi - lo)
                first = self.row


def _places() -> dict:
    """This worker's place of each lane: in ``sys``, as this module is sent anew with each batch."""
    return vars(sys).setdefault("_lakeshelf_places", {})


class AdmissionReader(DataSourceStreamReader):
    def __init__(self, options, schema: T.StructType):
        self.path, self.progress = options["path"], options["progress"]
        self.limit, self.start = int(options["rows"]), options["start"]
        self.lane, self.lanes = int(options.get("lane", 0)), int(options.get("lanes", 1))
        _checked(self.limit, self.start, self.lanes)
        self.lanes_file = options.get("lanes_file")  # what all lanes know, see read_lanes
        self.schema = schema
        self.files: list[list] | None = None  # [path, first, rows of this lane] in order of arrival
        self.end = {"file": 0, "row": 0}      # of the newest planned batch

    # ---- the written order -----------------------------------------------------
    def _restore(self) -> None:
        if self.files is not None:
            return
        self.files, self.parts = [], 0
        for f in sorted(_names(self.progress), key=lambda f: f.base_name):
            value = _get(self.progress, f.base_name)
            if f.base_name.startswith("files-"):
                self.files += value
                self.parts += 1
            else:
                self.end = value
        if not self.parts:  # the first start: files that count as read have no rows
            here = _get(*self.lanes_file.rsplit("/", 1))["here"] if self.lanes_file else [f.path for f in self._new()]
            self._arrived([[p, 0, 0] for p in here] if self.start == "latest" else [])

    def _new(self) -> list[pafs.FileInfo]:
        known = {f[0] for f in self.files}
        return sorted((f for f in _names(self.path) if f.path not in known), key=lambda f: (f.mtime_ns or 0, f.path))

    def _arrived(self, files: list[list]) -> None:
        _put(self.progress, f"files-{self.parts:012d}", files)
        self.files += files
        self.parts += 1

    def _share(self, rows: int) -> tuple[int, int]:
        """The first row and the number of rows of this lane in a file."""
        first = rows * self.lane // self.lanes
        return first, rows * (self.lane + 1) // self.lanes - first

    # ---- the source ------------------------------------------------------------
    def initialOffset(self) -> dict:
        return {"file": 0, "row": 0}

    def latestOffset(self) -> dict:
        """At most ``rows`` rows after the newest planned batch; footers are
        read only of as many new files as that takes."""
        self._restore()
        here = sum(n for _, _, n in self.files[self.end["file"]:]) - self.end["row"]
        fs, _ = _files(self.path)
        more = []
        for f in self._new() if here < self.limit else ():
            with fs.open_input_file(f.path) as s:
                more.append([f.path, *self._share(pq.read_metadata(s).num_rows)])
            here += more[-1][2]
            if here >= self.limit:
                break
        if more:
            self._arrived(more)
        at, row, left = self.end["file"], self.end["row"], self.limit
        while at < len(self.files) and self.files[at][2] - row <= left:
            left -= self.files[at][2] - row
            at, row = at + 1, 0
        return {"file": at, "row": row + left if at < len(self.files) else 0}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        self._restore()
        if end != self.end:
            _put(self.progress, "last", end)
            self.end = end
        out = []
        for i in range(start["file"], min(end["file"] + 1, len(self.files))):
            path, first, n = self.files[i]
            lo = first + (start["row"] if i == start["file"] else 0)
            hi = first + (end["row"] if i == end["file"] else n)
            out += [Range(path, a, min(a + TASK_ROWS, hi), self.lane) for a in range(lo, hi, TASK_ROWS)]
        return out

    def read(self, partition: Range):
        """The worker's place in the file that it last read for this lane is used
        again: one batch after the other, it decodes no row twice."""
        fs, _ = _files(self.path)
        want = to_arrow_schema(self.schema)
        info = fs.get_file_info(partition.path)
        key = (partition.path, info.size, info.mtime_ns, *want.names)
        known, place = _places().pop(partition.lane, (None, None))
        if known != key:
            place = Place(fs.open_input_file(partition.path), want.names)
        for b in place.take(partition.first, partition.last):
            yield pa.RecordBatch.from_arrays(
                [b.column(c.name).cast(c.type) if c.name in place.names else pa.nulls(b.num_rows, c.type) for c in want], schema=want)
        _places()[partition.lane] = key, place

    def commit(self, end: dict) -> None:
        """Nothing to release: the end was written when the batch was planned."""


class AdmissionSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamReader(self, schema: T.StructType) -> AdmissionReader:
        return AdmissionReader(self.options, schema)


# the class travels to the workers itself, so they need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def read_admitted(spark: SparkSession, path: str, schema: T.StructType, progress: str, rows: int = 500,
                  start: str = "earliest", **options) -> DataFrame:
    """Stream of the Parquet files at ``path`` with at most ``rows`` rows in a
    micro-batch. ``start="latest"`` skips what is there when the query first
    starts. An absent column is NULL. Use a processing-time trigger: an
    ``availableNow`` one runs a single batch."""
    # a name for each stream: Spark changes the environment kept with a source when a
    # stream starts, while another one of the same source may send it to its tasks
    name = f"{FORMAT}_{uuid.uuid4().hex[:12]}"
    spark.dataSource.register(type("Source", (AdmissionSource,), {"name": classmethod(lambda cls: name)}))
    return (spark.readStream.format(name).schema(schema).option("path", path).option("progress", progress)
            .option("rows", rows).option("start", start).options(**options).load())


def read_lanes(spark: SparkSession, path: str, schema: T.StructType, progress: str, rows: int = 500,
               start: str = "earliest", lanes: int = 1) -> list[DataFrame]:
    """Streams as of :func:`read_admitted` that run side by side, each over its
    own share of the rows of every file: a lane's micro-batch has at most ``rows``
    rows, so at most ``lanes * rows`` are in work at a time, in no order between
    lanes. Each lane needs a checkpoint of its own. The first call fixes their
    number and, with ``start="latest"``, what all of them skip."""
    _checked(rows, start, lanes)
    progress = progress.rstrip("/")
    if "lanes" not in (f.base_name for f in _names(progress)):
        _put(progress, "lanes", {"lanes": lanes, "here": [f.path for f in _names(path)] if start == "latest" else []})
    lanes = _get(progress, "lanes")["lanes"]
    return [read_admitted(spark, path, schema, f"{progress}/lane-{k}", rows, start, lane=k, lanes=lanes, lanes_file=f"{progress}/lanes")
            for k in range(lanes)]

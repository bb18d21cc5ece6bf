"""Session helpers: building a session for local runs, the shared scratch
folder (``spark.checkpoint.dir``), lineage cuts by written tables, and a
size-checked broadcast.

Nothing here holds data on the driver: the only driver-side values are row
counts and configuration strings.
"""

from __future__ import annotations

import contextlib
import functools
import os
import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Settings that matter at scale. AQE re-plans joins from runtime sizes, splits
# skewed shuffle partitions and coalesces small ones; they are on by default in
# Spark 4 but are stated so a cluster profile cannot silently drop them.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "lakeshelf", extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench. On a cluster, use the cluster's own
    session and call :func:`apply_scale_conf` instead."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "16g"))
    for k, v in {**SCALE_CONF, "spark.sql.session.timeZone": "UTC", **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_scale_conf(spark: SparkSession, input_bytes: int | None = None,
                     target_partition_bytes: int = 256 << 20) -> None:
    """Apply :data:`SCALE_CONF` to a (cluster) session. With the size of the
    largest input, also size the shuffle so partitions stay near
    ``target_partition_bytes``: the initial partition count covers the input
    (AQE then merges small ones towards the advisory size and splits skewed
    join partitions), and scans split files at the same size. For 100 TB at
    256 MB that is about 400,000 initial shuffle partitions."""
    for k, v in SCALE_CONF.items():
        spark.conf.set(k, v)
    if input_bytes:
        parts = max(200, -(-int(input_bytes) // target_partition_bytes))
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(parts))
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_partition_bytes))
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(target_partition_bytes))


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for written intermediate tables.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir). Only a local-mode session without one gets a private
    temporary folder; a cluster session without a shared folder is an error,
    because a machine-local folder is not visible to other executors."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        d = tempfile.mkdtemp(prefix="lakeshelf-")
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


_LOCAL = threading.local()


def _scopes() -> list[str]:
    """The open scratch scopes of this thread. A stream's batches run in a
    thread of their own: their scopes are not those of other streams or of the
    main thread."""
    if not hasattr(_LOCAL, "scopes"):
        _LOCAL.scopes = []
    return _LOCAL.scopes


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared scratch root (or the folder of
    this thread's current :func:`scratch_scope`)."""
    top = _scopes()[-1] if _scopes() else f"{scratch_root(spark)}/lakeshelf"
    return f"{top}/{name}-{uuid.uuid4().hex[:12]}"


@contextlib.contextmanager
def scratch_scope(spark: SparkSession):
    """Tables that :func:`materialize` writes inside the ``with`` block, in
    the same thread, are deleted at its end: for steps that write their result elsewhere before
    they return. (A query that returns a lazy DataFrame cannot know its last
    reader; its tables stay until the scratch folder is cleaned.)"""
    top = f"{scratch_root(spark)}/lakeshelf/scope-{uuid.uuid4().hex[:12]}"
    _scopes().append(top)
    try:
        yield top
    finally:
        _scopes().remove(top)
        p = hadoop_path(spark, top)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as parquet into the shared scratch folder and read it back.

    This cuts lineage (an executor loss re-reads the files instead of
    recomputing the upstream plan) and gives Catalyst exact file-size
    statistics for the written table."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


_WIDTH = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4,
    T.LongType: 8, T.FloatType: 4, T.DoubleType: 8, T.DateType: 4,
    T.TimestampType: 8, T.TimestampNTZType: 8,
}


def row_width(schema: T.StructType) -> int:
    """Rough in-memory bytes per row (strings and nested values at 32 bytes)."""
    total = 16
    for f in schema.fields:
        total += _WIDTH.get(type(f.dataType), 32)
    return total


def broadcast_limit(spark: SparkSession) -> int:
    raw = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760b")
    raw = raw.strip().lower()
    mult = 1
    for suf, m in (("kb", 1 << 10), ("mb", 1 << 20), ("gb", 1 << 30), ("k", 1 << 10),
                   ("m", 1 << 20), ("g", 1 << 30), ("b", 1)):
        if raw.endswith(suf):
            raw, mult = raw[: -len(suf)], m
            break
    try:
        return int(float(raw) * mult)
    except ValueError:
        return 10 << 20


def measured_bytes(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of ``df`` in one aggregate: fixed-width columns by their
    width, strings and binaries by their actual byte length, other nested
    values by a flat estimate."""
    var = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    fixed = row_width(T.StructType([f for f in df.schema.fields if f.name not in var]))
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.coalesce(F.sum(F.octet_length(F.col(f"`{c}`"))), F.lit(0)).alias(f"b{i}") for i, c in enumerate(var)]
    r = df.agg(*aggs).first()
    rows = int(r[0])
    return rows, rows * (fixed + 8 * len(var)) + sum(int(x) for x in r[1:])


def checked_broadcast(small: DataFrame, max_bytes: int | None = None,
                      known_rows: int | None = None, stored: bool = False) -> DataFrame:
    """Return ``small`` with a broadcast hint only if its size is proven to be
    under ``max_bytes`` (default: the session's broadcast threshold).

    ``known_rows`` is a proven upper bound on the rows (e.g. a literal code
    table); with columns of fixed width only, the bytes then follow from the
    schema. Otherwise the side is written to the shared
    scratch folder (``stored=True``: it already reads a stored table) and
    measured: row count and the actual byte length of its text columns. Above
    the limit the side is returned unhinted, so the join shuffles on its keys
    and AQE may still split skewed partitions."""
    spark = small.sparkSession
    limit = broadcast_limit(spark) if max_bytes is None else max_bytes
    if limit <= 0:
        return small
    if known_rows is not None and all(type(f.dataType) in _WIDTH for f in small.schema.fields):
        size = known_rows * row_width(small.schema)
    else:
        if not stored:
            small = materialize(small, "lookup")
        _, size = measured_bytes(small)
    return F.broadcast(small) if size <= limit else small


def checked_broadcasts(sides: list[DataFrame], max_bytes: int | None = None) -> list[DataFrame]:
    """:func:`checked_broadcast` of several sides that read stored tables,
    all measured by one aggregate."""
    if not sides:
        return []
    spark = sides[0].sparkSession
    limit = broadcast_limit(spark) if max_bytes is None else max_bytes
    parts = []
    for i, df in enumerate(sides):
        var = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
        fixed = row_width(T.StructType([f for f in df.schema.fields if f.name not in var])) + 8 * len(var)
        size = F.lit(fixed).cast("bigint")
        for c in var:
            size = size + F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0))
        parts.append(df.select(F.lit(i).alias("i"), size.alias("b")))
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    got = {r["i"]: int(r["b"]) for r in every.groupBy("i").agg(F.sum("b").alias("b")).collect()}  # a row for each side
    return [F.broadcast(df) if 0 < limit and got.get(i, 0) <= limit else df for i, df in enumerate(sides)]


@functools.lru_cache(1)
def _path_class(jvm):
    """A JVM's ``Path``: finding the class by its name takes longer than using it."""
    return jvm.org.apache.hadoop.fs.Path


def hadoop_path(spark: SparkSession, path: str):
    return _path_class(spark._jvm)(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on the cluster's file system (any scheme)."""
    p = hadoop_path(spark, path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is a folder on the cluster's file system (any scheme)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory())


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))

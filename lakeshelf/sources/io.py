"""Scans and sinks: layered table paths, JSON/CSV scans, inline code tables,
manifest-driven dated ingestion, and versioned (change-feed) parquet tables.

A versioned table is a parquet folder partitioned by ``_commit_version``.
Appending version ``v`` overwrites only the ``_commit_version=v`` folder
(dynamic partition overwrite), so a replay of the same version after a
failure does not duplicate rows. Reading the changes since a mark is a
partition-pruned filter on that column.
"""

from __future__ import annotations

import datetime as _dt
import os
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshelf.sources import history

VERSION = history.VERSION


# ---- scans -------------------------------------------------------------------

def layer_path(root: str, layer: str, table: str) -> str:
    return "/".join(p.strip("/") if i else p.rstrip("/")
                    for i, p in enumerate([root, layer, table]) if p)


def read_layer(spark: SparkSession, root: str, layer: str, table: str, fmt: str = "parquet",
               schema: T.StructType | str | None = None, **options) -> DataFrame:
    """Read ``<root>/<layer>/<table>`` in ``fmt``; ``fmt="table"`` reads the
    catalog table ``<layer>.<table>`` (``root`` is then the catalog, or empty)."""
    if fmt == "table":
        return spark.table(".".join(p for p in (root, layer, table) if p))
    r = spark.read.format(fmt).options(**options)
    if schema is not None:
        r = r.schema(schema)
    return r.load(layer_path(root, layer, table))


def read_json_partitioned(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                          multi_line: bool = False) -> DataFrame:
    """JSON scan; Hive-style ``k=v`` folders become partition columns.
    Without ``schema`` the types are inferred (a full pass over the files):
    give a schema on production paths."""
    r = spark.read.option("multiLine", multi_line)
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header row; types inferred when no schema is given."""
    r = spark.read.option("header", True)
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    return r.csv(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Ingest manifest: one JSON array of {relative_path, container_name,
    folder_destination, file_destination}."""
    schema = ("relative_path string, container_name string, folder_destination string, "
              "file_destination string")
    return spark.read.option("multiLine", True).schema(schema).json(path)


def code_table(spark: SparkSession, rows: Sequence[tuple], names: Sequence[str]) -> DataFrame:
    """Inline constant table (decode lists, category codes)."""
    return spark.createDataFrame(list(rows), list(names))


# ---- dated ingestion (bronze) -----------------------------------------------

def dated_folder(as_of: _dt.datetime) -> str:
    return f"year={as_of:%Y}/month={as_of:%m}/day={as_of:%d}"


def ingest(spark: SparkSession, entries: Iterable[dict], src_root: str, dst_root: str,
           as_of: _dt.datetime, src_format: str = "parquet", dst_format: str = "json") -> list[str]:
    """Copy each manifest entry to
    ``<dst_root>/<container_name>/<folder_destination>/year=yyyy/month=MM/day=dd/<file>_HHmm``
    (entries without a container go to ``dst_root`` itself).

    The loop runs over manifest entries (a handful of configuration rows);
    each copy is a distributed read and write. ``as_of`` is a parameter so a
    rerun of the same day writes the same folders (overwrite, idempotent)."""
    written = []
    for e in entries:
        src = os.path.join(src_root, e["relative_path"])
        dst = "/".join(x for x in (dst_root.rstrip("/"), (e.get("container_name") or "").strip("/"),
                                   e["folder_destination"].strip("/"), dated_folder(as_of),
                                   f"{e['file_destination']}_{as_of:%H%M}") if x)
        spark.read.format(src_format).load(src).write.mode("overwrite").format(dst_format).save(dst)
        written.append(dst)
    return written


def latest_partition(df: DataFrame, year: str = "year", month: str = "month", day: str = "day") -> DataFrame:
    """One row: the newest ``yyyyMMdd`` over date columns (parts may be
    unpadded integers), by a scan. For a stored table partitioned by date use
    :func:`newest_date`, which only lists folders."""
    d = F.to_date(F.concat_ws("-", F.col(year), F.col(month), F.col(day)))
    return df.select(F.date_format(d, "yyyyMMdd").alias("ingestion")).agg(
        F.max("ingestion").alias("max_ingestion"))


# ---- versioned tables --------------------------------------------------------

def append_version(df: DataFrame, path: str, version: int | Column | None = None,
                   max_records_per_file: int | None = None) -> None:
    """Write ``df`` as version(s) of the table at ``path``.

    ``version`` = an int stamps every row; ``None`` keeps the rows' own
    ``_commit_version`` column. Only the written versions are replaced. The
    finished write is recorded in the table's history; versions of rows are
    gathered in the same pass."""
    spark = df.sparkSession
    existed = _folder_values(spark, path, VERSION)
    if version is not None:
        v = version if isinstance(version, Column) else F.lit(int(version))
        df = df.withColumn(VERSION, v.cast("int"))
    seen = None if isinstance(version, int) else Observation()
    if seen:
        df = df.observe(seen, F.collect_set(VERSION).alias("versions"))
    # AQE then writes few files for a small version and splits a large one
    w = (df.hint("rebalance", VERSION).write.mode("overwrite")
           .option("partitionOverwriteMode", "dynamic").partitionBy(VERSION))
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.parquet(path)
    history.record(spark, path, seen.get["versions"] if seen else [version], existed)


def read_versions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_changes(table: DataFrame, since: int, until: int | None = None) -> DataFrame:
    """Rows of versions in ``(since, until]`` (append-only change sets). The
    filter is on the partition column, so only those folders are listed."""
    cond = F.col(VERSION) > since
    if until is not None:
        cond = cond & (F.col(VERSION) <= until)
    return table.where(cond)


def _folder_values(spark: SparkSession, path: str, column: str) -> list[int]:
    """Values of the folders ``<column>=<int>`` in ``path`` (one listing, no
    Spark job)."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]
    values = [n[len(column) + 1:] for n in names if n.startswith(column + "=")]
    return [int(v) for v in values if v.lstrip("-").isdigit()]


def latest_version(spark: SparkSession, path: str) -> int | None:
    """Newest version of the table at ``path`` from its folder names; None if
    it has none."""
    return max(_folder_values(spark, path, VERSION), default=None)


def current_version(spark: SparkSession, path: str) -> DataFrame:
    """One row: the newest version of the table at ``path``, without a scan."""
    return spark.createDataFrame([(latest_version(spark, path),)], "current_version int")


def newest_date(spark: SparkSession, path: str) -> DataFrame:
    """One row: the newest ``yyyyMMdd`` of a table partitioned by year, month
    and day, from three folder listings."""
    parts = []
    for column in ("year", "month", "day"):
        v = max(_folder_values(spark, "/".join([path, *[f"{c}={x}" for c, x in parts]]), column), default=None)
        if v is None:
            return spark.createDataFrame([(None,)], "max_ingestion string")
        parts.append((column, _shown(spark, path, parts, column, v)))
    return spark.createDataFrame([(f"{int(parts[0][1]):04d}{int(parts[1][1]):02d}{int(parts[2][1]):02d}",)], "max_ingestion string")


def _shown(spark: SparkSession, path: str, parts: list, column: str, value: int) -> str:
    """How a folder writes its value: plain or padded to two digits."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path("/".join([path, *[f"{c}={x}" for c, x in parts], f"{column}={value}"]))
    plain = p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
    return str(value) if plain else f"{value:02d}"

"""Small control files that at most one writer creates: the one primitive
behind marks, published table states and committed stream batches."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

from lakeshelf.session import hadoop_path


def hadoop_fs(spark: SparkSession, path: str):
    p = hadoop_path(spark, path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def is_local(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is on a local or mounted file system."""
    fs, p = hadoop_fs(spark, path)
    return fs.makeQualified(p).toUri().getScheme() == "file"


def create_exclusive(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small text file, complete under its name or not there, unless
    it exists: of several writers exactly one gets True.

    On a local or mounted file system the file is linked into place (a link
    never replaces); elsewhere it is renamed without overwriting, which the
    cluster's file system does atomically."""
    fs, p = hadoop_fs(spark, path)
    p = fs.makeQualified(p)
    name = f".{uuid.uuid4().hex}.tmp"
    if p.toUri().getScheme() == "file":
        final = p.toUri().getPath()
        folder = os.path.dirname(final)
        os.makedirs(folder, exist_ok=True)
        local = os.path.join(folder, name)
        with open(local, "w", encoding="utf-8") as f:
            f.write(text)
            f.flush()
            os.fsync(f.fileno())
        try:
            os.link(local, final)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(local)
    hp = spark._jvm.org.apache.hadoop.fs.Path
    tmp = hp(p.getParent(), name)
    out = fs.create(tmp, True)
    out.write(bytearray(text.encode()))
    out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(tmp, p, options)
        return True
    except Exception:
        if fs.exists(p):
            return False
        raise
    finally:
        fs.delete(tmp, False)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = hadoop_fs(spark, path)
    jio = spark._jvm.java.io
    reader = jio.BufferedReader(jio.InputStreamReader(fs.open(p), "UTF-8"))
    try:
        return reader.readLine() or ""
    finally:
        reader.close()


def names_in(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(name, modification time in ms) of what a folder holds; none if it
    does not exist."""
    fs, p = hadoop_fs(spark, path)
    return [(st.getPath().getName(), st.getModificationTime()) for st in fs.listStatus(p)] if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, p = hadoop_fs(spark, path)
    fs.delete(p, True)

"""A trigram index of a text column: which files hold which three-character
sequences. A search for a regular expression opens only files that hold the
trigrams of its literal parts; the expression itself decides.

Only trigrams of ASCII characters are indexed, folded to lower case; letters
beyond ASCII that a case-insensitive expression takes for an ASCII letter are
folded to it. Expressions without three literal characters in a row in each
alternative, or with groups, read every file."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshelf.functions.predicates import matches_ci

BUCKET, BUCKETS = "_bucket", 64
# Letters beyond ASCII that fold to an ASCII letter, and that letter.
FOLDS_FROM, FOLDS_TO = "İıſK", "iisk"


def fold(c: str | Column) -> Column:
    return F.lower(F.translate(c, FOLDS_FROM, FOLDS_TO))


def trigrams(c: str | Column) -> Column:
    """The distinct indexed trigrams of a text; linear in its length."""
    chars = F.split(fold(c), "")
    n = F.size(chars)
    every = F.transform(F.sequence(F.lit(1), F.greatest(n - 2, F.lit(1))),
                        lambda i: F.concat(F.get(chars, i - 1), F.get(chars, i), F.get(chars, i + 1)))
    return F.filter(F.array_distinct(every), lambda g: g.rlike(r"^[\x00-\x7f]{3}$"))  # NULL: texts below three characters


def build(spark: SparkSession, table: str, column: str, path: str) -> None:
    """Index ``column`` of the Parquet files at ``table``: (file, trigram) in
    hash buckets of trigrams. Pairs are reduced before they are shuffled."""
    rows = spark.read.parquet(table).select(F.col("_metadata.file_path").alias("file"), F.explode(trigrams(column)).alias("trigram"))
    pairs = rows.distinct().withColumn(BUCKET, F.pmod(F.hash("trigram"), F.lit(BUCKETS)))
    (pairs.repartitionByRange(BUCKET, "trigram").sortWithinPartitions(BUCKET, "trigram")
     .write.mode("overwrite").partitionBy(BUCKET).parquet(path))


_PLAIN_CLASSES = set("dDwWsSbBtnrfhv")


def literal_runs(pattern: str) -> list[list[str]] | None:
    """For each alternative of a regular expression, the literal texts that
    every match contains; None if that cannot be told (groups, flags, quoted
    or coded characters, nested classes)."""
    out, runs, run = [], [], ""
    i = 0
    while i < len(pattern):
        ch = pattern[i]
        if ch in "()":
            return None
        if ch == "\\":
            nxt = pattern[i + 1:i + 2]
            if not nxt or (nxt.isalnum() and nxt not in _PLAIN_CLASSES):
                return None
            if nxt.isalnum():
                runs, run = runs + [run], ""
            else:
                run += nxt
            i += 2
            continue
        if ch == "[":
            end = pattern.find("]", i + 2)
            if end < 0 or "[" in pattern[i + 1:end] or "\\" in pattern[i + 1:end]:
                return None
            runs, run, i = runs + [run], "", end + 1
            continue
        if ch in "?*{":  # the character before may be absent
            runs, run = runs + [run[:-1]], ""
            if ch == "{":
                end = pattern.find("}", i)
                if end < 0:
                    return None
                i = end
        elif ch in "+.^$":
            runs, run = runs + [run], ""
        elif ch == "|":
            out.append(runs + [run])
            runs, run = [], ""
        else:
            run += ch
        i += 1
    return out + [runs + [run]]


def required(pattern: str) -> list[list[str]] | None:
    """For each alternative the trigrams that every match holds; None if some
    alternative has none."""
    found = literal_runs(pattern)
    if found is None:
        return None
    out = []
    for runs in found:
        folded = [r.translate(str.maketrans(FOLDS_FROM, FOLDS_TO)).lower() for r in runs]
        grams = sorted({r[i:i + 3] for r in folded for i in range(len(r) - 2) if re.fullmatch(r"[\x00-\x7f]{3}", r[i:i + 3])})
        if not grams:
            return None
        out.append(grams)
    return out


def files_for(spark: SparkSession, index: str, pattern: str) -> list[str] | None:
    """The files that may hold a match; None: all. The list has at most an
    entry for each file, as Spark's own listing of the table."""
    want = required(pattern)
    if want is None:
        return None
    rows = [(a, g) for a, grams in enumerate(want) for g in grams]
    w = spark.createDataFrame(rows, "alternative int, trigram string").withColumn(BUCKET, F.pmod(F.hash("trigram"), F.lit(BUCKETS)))
    buckets = [r[0] for r in w.select(BUCKET).distinct().collect()]  # from the pattern's characters
    found = spark.read.schema(f"file string, trigram string, {BUCKET} int").parquet(index).where(F.col(BUCKET).isin(buckets) & F.col("trigram").isin(sorted({g for _, g in rows})))
    need = F.lit(None).cast("int")
    for a, grams in enumerate(want):
        need = F.when(F.col("alternative") == a, F.lit(len(grams))).otherwise(need)
    hits = (found.join(F.broadcast(w.drop(BUCKET)), "trigram").groupBy("file", "alternative")
            .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == need).select("file").distinct())
    return sorted(r["file"] for r in hits.collect())


def search(spark: SparkSession, table: str, index: str, column: str, pattern: str) -> DataFrame:
    """Rows of the table whose ``column`` matches (case-insensitive regular
    expression, as :func:`matches_ci`), reading only files that may hold one."""
    every = spark.read.parquet(table)
    files = files_for(spark, index, pattern)
    if files is not None:
        every = spark.read.schema(every.schema).parquet(*files) if files else every.limit(0)
    return every.where(matches_ci(column, pattern))

"""Tables clustered by several columns (Z-order) with bounds for each file,
and searches that open only files that can hold an answer.

Each column's rank among its quantiles gives ``BITS`` bits; the bits of all
columns are interleaved and the rows range-shuffled by the result, so that a
file covers a small range of every column. NULL and NaN rank first and count
in ``bad``; they are in no range."""

from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshelf.functions.predicates import present
from lakeshelf.operators import search as se

BITS = 6


def _number(c: str) -> Column:
    return F.col(c).cast("double")


def interleave(ranks: Sequence[Column], bits: int = BITS) -> Column:
    """The bits of the ranks in turn, highest first (bits x columns below 63)."""
    out = F.lit(0).cast("bigint")
    for b in range(bits - 1, -1, -1):
        for r in ranks:
            out = F.shiftleft(out, 1).bitwiseOR(F.shiftright(r.cast("bigint"), b).bitwiseAND(F.lit(1)))
    return out


def rank(v: Column, cuts: Sequence[float], first: int = 0) -> Column:
    """How many of the sorted cuts are at or below ``v``: a binary search of
    nested conditions, so that a row makes ``BITS`` comparisons."""
    if not cuts:
        return F.lit(first)
    mid = len(cuts) // 2
    return F.when(v < float(cuts[mid]), rank(v, cuts[:mid], first)).otherwise(rank(v, cuts[mid + 1:], first + mid + 1))


def write_clustered(df: DataFrame, path: str, columns: Sequence[str], files: int) -> None:
    """Write ``df`` to ``path`` in about ``files`` files and the bounds of the
    numeric ``columns`` in each to ``<path>_bounds``. Quantiles may be
    approximate: they only decide which rows lie together."""
    if len(columns) * BITS > 62:
        raise ValueError("too many columns to interleave")
    spark = df.sparkSession
    cuts = [(i / (1 << BITS)) for i in range(1, 1 << BITS)]
    one = df.agg(*[F.percentile_approx(F.when(present(_number(c)), _number(c)), cuts, 10000).alias(c) for c in columns]).first()
    ranks = [F.when(present(_number(c)), rank(_number(c), sorted(set(one[c] or [])))).otherwise(0) for c in columns]
    z = interleave(ranks)
    rows = df.withColumn("__z", z).repartitionByRange(files, "__z", *columns).sortWithinPartitions("__z").drop("__z")
    rows.write.mode("overwrite").parquet(path)
    stored = spark.read.parquet(path)
    aggs = [F.count(F.lit(1)).alias("rows")]
    for c in columns:
        v = F.when(present(_number(c)), _number(c))
        aggs += [F.min(v).alias(f"{c}_min"), F.max(v).alias(f"{c}_max"), F.count_if(~present(_number(c))).alias(f"{c}_bad")]
    stored.groupBy(F.col("_metadata.file_path").alias("file")).agg(*aggs).write.mode("overwrite").parquet(f"{path}_bounds")


def ranges(c: se.Criteria, cols: Mapping[str, str] = se.DEFAULT_COLS) -> dict[str, tuple[float | None, float | None]]:
    """The range criteria by column of the table (price always: it must be present)."""
    r = {"price": (c.min_price, c.max_price), "area": (c.min_area, c.max_area),
         "bedrooms": (c.min_bedrooms, None), "bathrooms": (c.min_bathrooms, None)}
    return {cols[k]: v for k, v in r.items() if k == "price" or v != (None, None)}


def _only_ranges(c: se.Criteria) -> bool:
    return not any((c.city, c.district, c.property_type, c.transaction_type)) and c.furnished is None


def plan(spark: SparkSession, path: str, c: se.Criteria, cols: Mapping[str, str] = se.DEFAULT_COLS) -> list[tuple[str, float, int | None]]:
    """(file, least price, rows) of the files that may hold matches, cheapest
    first; ``rows`` is given if every row of the file is known to match. An
    entry for each file at most, as in Spark's own listing."""
    b = spark.read.parquet(f"{path}_bounds")
    may, all_in = [F.lit(True)], [F.lit(_only_ranges(c))]
    for col, (lo, hi) in ranges(c, cols).items():
        if f"{col}_min" not in b.columns:
            all_in.append(F.lit(False))
            continue
        low, high = F.col(f"{col}_min"), F.col(f"{col}_max")
        may.append(low.isNotNull())
        all_in.append(F.col(f"{col}_bad") == 0)
        if lo is not None:
            may.append(high >= lo)
            all_in.append(low >= lo)
        if hi is not None:
            may.append(low <= hi)
            all_in.append(high <= hi)
    both = lambda ps: reduce(lambda x, y: x & y, ps)
    rows = b.where(both(may)).select("file", F.col(f"{cols['price']}_min").alias("p"), F.when(both(all_in), F.col("rows")).alias("n"))
    return [tuple(r) for r in rows.orderBy("p", "file").collect()]


def search(spark: SparkSession, path: str, c: se.Criteria, k: int = 5, cols: Mapping[str, str] = se.DEFAULT_COLS,
           show: Sequence[str] | None = None) -> tuple[DataFrame, list[str]]:
    """The cheapest ``k`` matches (ties by id) with ``total``, as
    :func:`lakeshelf.operators.search.search`, and the files that were opened.

    Files whose rows may or may not match are read once, for the total and
    the top rows together. Of the others, whose rows all match, the count is
    known: they are opened in the order of their least price, twice as many
    each time, until the k-th price found is below the next file's least."""
    show = list(show or [cols[f] for f in se.SHOWN])
    price, rid = cols["price"], cols["row_id"]
    schema = spark.read.parquet(path).schema
    files = plan(spark, path, c, cols)
    partly = [f for f, _, n in files if n is None]
    whole = [(f, p) for f, p, n in files if n is not None]
    total = sum(n for _, _, n in files if n is not None)
    wanted = list(dict.fromkeys([*show, price, rid]))
    order = [F.asc_nulls_last(price), F.asc(rid)]
    best: list = []  # at most k rows

    def read(names: list[str]) -> int:
        seen = Observation()
        hits = se.search_filter(spark.read.schema(schema).parquet(*names), c, cols)
        top = hits.observe(seen, F.count(F.lit(1)).alias("n")).select(*wanted).orderBy(*order).limit(k).collect()
        rows = spark.createDataFrame([*best, *top], T.StructType([schema[x] for x in wanted]))
        best[:] = rows.orderBy(*order).limit(k).collect()
        return int(seen.get["n"])

    opened = list(partly)
    if partly:
        total += read(partly)
    step = 1
    while whole and (len(best) < k or whole[0][1] <= best[-1][price]):
        now, whole = [f for f, _ in whole[:step]], whole[step:]
        read(now)
        opened += now
        step *= 2
    out = spark.createDataFrame(best, T.StructType([schema[x] for x in wanted]))
    return out.select(*show, F.lit(total).cast("bigint").alias("total")), opened

"""Parametric faceted search over a listing table: optional conjunctive
criteria, top-k with the total match count, a detail card, facets and
price ranges.

Every criterion becomes a ``Column`` predicate, so the whole filter is one
expression that Catalyst pushes into the parquet scan where it can. The
top-k is ``orderBy(...).limit(k)`` which Spark plans as
``TakeOrderedAndProject`` (each partition keeps k rows). Column names are
configurable through ``cols`` so any table can be searched.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshelf.functions.predicates import all_of, eq_ci, matches_ci, present
from lakeshelf.operators.dims import dedup_latest
from lakeshelf.operators.impute import exact_median
from lakeshelf.session import checked_broadcast

DEFAULT_COLS = {f: f for f in (
    "row_id", "city", "district", "property_type", "transaction_type", "price", "bedrooms",
    "bathrooms", "livings", "area", "age", "has_furnished", "has_air_condition", "has_kitchen",
    "rent_period", "user_name", "is_verified")}

# Fields of a search result.
SHOWN = ("row_id", "property_type", "city", "district", "price", "transaction_type", "bedrooms", "bathrooms", "area",
         "has_furnished", "has_air_condition", "age")


@dataclass(frozen=True)
class Criteria:
    city: str | None = None
    district: str | None = None
    property_type: str | None = None
    transaction_type: str | None = None
    min_price: float | None = None
    max_price: float | None = None
    min_bedrooms: int | None = None
    min_bathrooms: int | None = None
    min_area: float | None = None
    max_area: float | None = None
    furnished: bool | None = None


def relax(c: Criteria, factor: float = 0.7) -> Criteria:
    """"Cheaper": the price ceiling becomes ``factor`` x the current one."""
    if c.max_price is None:
        return c
    return replace(c, max_price=c.max_price * factor)


def predicate(c: Criteria, cols: Mapping[str, str] = DEFAULT_COLS) -> Column:
    """Conjunction of the given criteria plus "price is present" (neither
    NULL nor NaN; a NaN is in no range either). Text
    criteria: city/district are case-insensitive regex containment (NULL
    never matches), type/transaction are case-insensitive equality with a
    trimmed parameter; ranges are inclusive."""
    col = lambda f: F.col(cols[f])
    p = [present(col("price"))]
    if c.city:
        p.append(matches_ci(col("city"), c.city))
    if c.district:
        p.append(matches_ci(col("district"), c.district))
    if c.property_type:
        p.append(eq_ci(col("property_type"), c.property_type))
    if c.transaction_type:
        p.append(eq_ci(col("transaction_type"), c.transaction_type))
    for v, f, op in ((c.min_price, "price", "ge"), (c.max_price, "price", "le"),
                     (c.min_bedrooms, "bedrooms", "ge"), (c.min_bathrooms, "bathrooms", "ge"),
                     (c.min_area, "area", "ge"), (c.max_area, "area", "le")):
        if v is not None:
            p.append((col(f) >= v) & ~F.isnan(col(f)) if op == "ge" else col(f) <= v)
    if c.furnished is not None:
        p.append(col("has_furnished") == ("Yes" if c.furnished else "No"))
    return all_of(p)


def search_filter(df: DataFrame, c: Criteria, cols: Mapping[str, str] = DEFAULT_COLS) -> DataFrame:
    return df.where(predicate(c, cols))


def search(df: DataFrame, c: Criteria, k: int = 5, cols: Mapping[str, str] = DEFAULT_COLS,
           show: Sequence[str] | None = None) -> DataFrame:
    """Top ``k`` matches by ascending price (ties by id) with ``total`` = the
    number of all matches, as a scalar subquery evaluated once."""
    hits = search_filter(df, c, cols)
    show = list(show or [cols[f] for f in SHOWN])
    total = hits.agg(F.count(F.lit(1))).scalar()
    top = hits.orderBy(F.asc_nulls_last(cols["price"]), F.asc(cols["row_id"])).limit(k)
    return top.select(*show, total.alias("total"))


def _int_text(c: Column, suffix: str = "") -> Column:
    txt = F.format_number(c.cast("bigint"), 0) if suffix == " SAR" else c.cast("bigint").cast("string")
    return F.when(c.isNull(), F.lit("N/A")).otherwise(F.concat(txt, F.lit(suffix)))


def detail(df: DataFrame, ids: DataFrame, cols: Mapping[str, str] = DEFAULT_COLS,
           order: Sequence[str] = ("updated_at", "_commit_version")) -> DataFrame:
    """Detail cards (17 labelled text fields, "N/A" when missing, price with
    thousands separators) for the rows whose id is in ``ids`` (one column).
    ``ids`` is a short list (a search result): it is size-checked before
    broadcasting. A repeated id shows its newest row by those of the
    ``order`` columns that the table has (the whole row breaks ties)."""
    col = lambda f: F.col(cols[f])
    idc = ids.columns[0]
    hits = df.join(checked_broadcast(ids.select(F.col(idc).alias(cols["row_id"])).distinct()),
                   cols["row_id"], "left_semi")
    rest = [c for c in hits.columns if c != cols["row_id"]]
    hits = dedup_latest(hits, [cols["row_id"]], [*[c for c in order if c in rest], *rest])
    return hits.select(
        col("row_id").alias("property_id"), col("property_type").alias("type"),
        col("transaction_type").alias("transaction"), col("city").alias("city"),
        col("district").alias("district"), _int_text(col("price"), " SAR").alias("price"),
        _int_text(col("area"), " sqm").alias("area"), _int_text(col("bedrooms")).alias("bedrooms"),
        _int_text(col("bathrooms")).alias("bathrooms"), _int_text(col("livings")).alias("living_rooms"),
        col("has_furnished").alias("furnished"), col("has_air_condition").alias("air_conditioning"),
        col("has_kitchen").alias("kitchen"), _int_text(col("age"), " years").alias("age"),
        col("rent_period").alias("rent_period"),
        F.coalesce(col("user_name"), F.lit("N/A")).alias("advertiser"),
        col("is_verified").alias("verified"))


def facets(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(facet, value): the sorted distinct non-NULL values of each column."""
    parts = [df.select(F.lit(n).alias("facet"), F.col(n).cast("string").alias("value"))
               .where(F.col(n).isNotNull()) for n in names]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct().orderBy("facet", "value")


def facet_by_parent(df: DataFrame, parent: str, pattern: str, child: str) -> DataFrame:
    """Sorted distinct ``child`` values of rows whose ``parent`` matches
    ``pattern`` (case-insensitive regex containment)."""
    return (df.where(matches_ci(parent, pattern) & F.col(child).isNotNull())
              .select(child).distinct().orderBy(child))


def price_range_of(df: DataFrame, property_type: str | None = None, transaction_type: str | None = None,
                   cols: Mapping[str, str] = DEFAULT_COLS) -> DataFrame:
    """One row (min, max, median) of the prices that are present, truncated to
    integers, of the listings of a type and a transaction type, each optional
    (case-insensitive); 0, 0, 0 if there are none."""
    m = F.col(cols["price"])
    p = [present(m)] + [F.coalesce(F.lower(F.col(cols[f])) == v.lower(), F.lit(False))
                        for f, v in (("property_type", property_type), ("transaction_type", transaction_type)) if v]
    x = df.where(all_of(p)).select(F.lit(0).alias("__k"), m.cast("double").alias("__m"))
    none = F.lit(None).cast("double")
    rows = x.agg(F.min("__m").alias("mn"), F.max("__m").alias("mx"), none.alias("md")).unionByName(
        exact_median(x, "__k", "__m", name="md").select(none.alias("mn"), none.alias("mx"), "md"))
    out = rows.agg(*[F.max(c).alias(c) for c in ("mn", "mx", "md")])  # two rows
    return out.select(*[F.coalesce(F.col(c).cast("bigint"), F.lit(0).cast("bigint")).alias(n)
                        for c, n in (("mn", "min"), ("mx", "max"), ("md", "median"))])


def options(df: DataFrame, deals: Sequence[str] = ("Sell", "Rental"), cols: Mapping[str, str] = DEFAULT_COLS) -> DataFrame:
    """What a customer can choose from: a row (option, value, min, max,
    median) for each city and property type, and the price range of each deal."""
    null = [F.lit(None).cast("bigint").alias(c) for c in ("min", "max", "median")]
    out = facets(df, [cols["city"], cols["property_type"]]).select(F.col("facet").alias("option"), "value", *null)
    ranges = price_range(df, cols["transaction_type"], list(deals), cols["price"])
    return out.unionByName(ranges.select(F.lit("price").alias("option"), F.col(cols["transaction_type"]).alias("value"), "min", "max", "median"))


def price_range(df: DataFrame, by: str, values: Sequence[str], measure: str = "price") -> DataFrame:
    """For each requested ``by`` value (case-insensitive): min, max and
    interpolated median of ``measure`` truncated to integers; a value with no
    rows gets 0, 0, 0. The median is exact and skew-safe."""
    spark = df.sparkSession
    want = spark.createDataFrame([(v, v.lower()) for v in values], f"{by} string, __k string")
    x = df.select(F.lower(F.col(by)).alias("__k"), F.col(measure).alias("__m")) \
          .where(present("__m"))
    x = x.join(F.broadcast(want.select("__k")), "__k", "left_semi")  # literal list: bounded
    mm = x.groupBy("__k").agg(F.min("__m").alias("mn"), F.max("__m").alias("mx"))
    med = exact_median(x, "__k", "__m", interpolate=True, name="md")
    stats = mm.join(med, "__k", "left")
    out = want.join(F.broadcast(stats), "__k", "left")
    z = F.lit(0).cast("bigint")
    return out.select(by, F.coalesce(F.col("mn").cast("bigint"), z).alias("min"),
                      F.coalesce(F.col("mx").cast("bigint"), z).alias("max"),
                      F.coalesce(F.col("md").cast("bigint"), z).alias("median"))

"""Search queries over the listing table (orders shaped as listings)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeshelf.operators import search as se
from lakeshelf.plans.registry import query
from lakeshelf.plans.roles import LISTINGS_SQL as L
from lakeshelf.plans.roles import listings
from lakeshelf.session import read_table

FILTER = se.Criteria(city="amer", property_type=" building ", min_price=100000, max_price=300000,
                     min_bedrooms=2, min_bathrooms=2, min_area=1000, max_area=3000, furnished=True)
TEXT = se.Criteria(district=r"n_1\d$|_3$")
TOP = se.Criteria(transaction_type="f", min_bedrooms=3)
CHEAPER = se.relax(se.Criteria(city="europe", max_price=200000))

FILTER_SQL = f"""(SELECT * FROM {L} l WHERE price IS NOT NULL AND regexp_matches(city, '(?i)amer')
  AND lower(property_type) = 'building' AND price >= 100000 AND price <= 300000 AND bedrooms >= 2
  AND bathrooms >= 2 AND area >= 1000 AND area <= 3000 AND has_furnished = 'Yes')"""
TOP_SQL = f"(SELECT * FROM {L} l WHERE price IS NOT NULL AND lower(transaction_type) = 'f' AND bedrooms >= 3)"
CHEAPER_SQL = f"(SELECT * FROM {L} l WHERE price IS NOT NULL AND regexp_matches(city, '(?i)europe') AND price <= {200000 * 0.7})"
SHOW = ("row_id, property_type, city, district, price, transaction_type, bedrooms, bathrooms, area, "
        "has_furnished, has_air_condition, age")


def _top_sql(hits: str) -> str:
    return f"""SELECT {SHOW}, (SELECT count(*) FROM {hits} c) AS total FROM {hits} h
ORDER BY price, row_id LIMIT 5"""


@query("search_filter", f"""
SELECT row_id, city, district, property_type, price, bedrooms, bathrooms, area, has_furnished FROM {FILTER_SQL} x""")
def q_search_filter(spark, sf):
    return se.search_filter(listings(spark, sf), FILTER).select(
        "row_id", "city", "district", "property_type", "price", "bedrooms", "bathrooms", "area", "has_furnished")


@query("search_text", f"""
SELECT row_id, district FROM {L} l WHERE price IS NOT NULL AND regexp_matches(district, '(?i)n_1\\d$|_3$')""")
def q_search_text(spark, sf):
    return se.search_filter(listings(spark, sf), TEXT).select("row_id", "district")


@query("search_top5", _top_sql(TOP_SQL))
def q_search_top5(spark, sf):
    return se.search(listings(spark, sf), TOP)


@query("search_cheaper", _top_sql(CHEAPER_SQL))
def q_search_cheaper(spark, sf):
    return se.search(listings(spark, sf), CHEAPER)


def _n(e: str, suffix: str = "") -> str:
    return f"CASE WHEN {e} IS NULL THEN 'N/A' ELSE CAST(CAST(trunc({e}) AS BIGINT) AS VARCHAR) || '{suffix}' END"


@query("lookup_by_id", f"""
WITH ids AS (SELECT row_id FROM (SELECT row_id FROM {TOP_SQL} t ORDER BY price, row_id LIMIT 5) i)
SELECT row_id AS property_id, property_type AS type, transaction_type AS transaction, city, district,
  CASE WHEN price IS NULL THEN 'N/A' ELSE format('{{:,}}', CAST(trunc(price) AS BIGINT)) || ' SAR' END AS price,
  {_n('area', ' sqm')} AS area, {_n('bedrooms')} AS bedrooms, {_n('bathrooms')} AS bathrooms,
  {_n('livings')} AS living_rooms, has_furnished AS furnished, has_air_condition AS air_conditioning,
  has_kitchen AS kitchen, {_n('age', ' years')} AS age, rent_period,
  coalesce(user_name, 'N/A') AS advertiser, is_verified AS verified
FROM {L} l WHERE row_id IN (SELECT row_id FROM ids)""")
def q_lookup_by_id(spark, sf):
    """Detail cards for the ids a search returned (search -> details)."""
    li = listings(spark, sf)
    ids = se.search(li, TOP).select("row_id")
    return se.detail(li, ids)


@query("facets", f"""
SELECT DISTINCT 'city' AS facet, CAST(city AS VARCHAR) AS value FROM {L} a WHERE city IS NOT NULL
UNION SELECT DISTINCT 'property_type', property_type FROM {L} b WHERE property_type IS NOT NULL""")
def q_facets(spark, sf):
    return se.facets(listings(spark, sf), ["city", "property_type"])


@query("facet_by_parent", f"""
SELECT DISTINCT district FROM {L} l WHERE regexp_matches(city, '(?i)asia') AND district IS NOT NULL""")
def q_facet_by_parent(spark, sf):
    return se.facet_by_parent(listings(spark, sf), "city", "asia", "district")


PRICE_TYPES = ["F", "O", "P", "X"]


@query("price_range", f"""
SELECT w.transaction_type, coalesce(CAST(trunc(min(l.price)) AS BIGINT), 0) AS min,
  coalesce(CAST(trunc(max(l.price)) AS BIGINT), 0) AS max,
  coalesce(CAST(trunc(median(l.price)) AS BIGINT), 0) AS median
FROM (VALUES {', '.join(f"('{v}')" for v in PRICE_TYPES)}) w(transaction_type)
LEFT JOIN {L} l ON lower(l.transaction_type) = lower(w.transaction_type) AND l.price IS NOT NULL
GROUP BY w.transaction_type""")
def q_price_range(spark, sf):
    return se.price_range(listings(spark, sf), "transaction_type", PRICE_TYPES)


NAN_SQL = f"(SELECT * REPLACE (CASE WHEN transaction_type = 'P' THEN 'NaN'::DOUBLE ELSE price END AS price) FROM {L} n)"


def _nan_prices(spark, sf):
    """Listings whose price is NaN in one transaction type."""
    price = F.when(F.col("transaction_type") == "P", F.lit(float("nan"))).otherwise(F.col("price"))
    return listings(spark, sf).withColumn("price", price)


@query("search_nan_price", f"SELECT row_id, price FROM {NAN_SQL} x WHERE NOT isnan(price) AND price >= 50 AND bedrooms >= 4")
def q_search_nan_price(spark, sf):
    return se.search_filter(_nan_prices(spark, sf), se.Criteria(min_price=50, min_bedrooms=4)).select("row_id", "price")


@query("price_range_nan", f"""
SELECT w.transaction_type, coalesce(CAST(trunc(min(l.price)) AS BIGINT), 0) AS min,
  coalesce(CAST(trunc(max(l.price)) AS BIGINT), 0) AS max,
  coalesce(CAST(trunc(median(l.price)) AS BIGINT), 0) AS median
FROM (VALUES {', '.join(f"('{v}')" for v in PRICE_TYPES)}) w(transaction_type)
LEFT JOIN {NAN_SQL} l ON lower(l.transaction_type) = lower(w.transaction_type) AND l.price IS NOT NULL AND NOT isnan(l.price)
GROUP BY w.transaction_type""")
def q_price_range_nan(spark, sf):
    return se.price_range(_nan_prices(spark, sf), "transaction_type", PRICE_TYPES)


@query("price_range_two_filters", f"""
SELECT coalesce(CAST(trunc(min(price)) AS BIGINT), 0) AS min, coalesce(CAST(trunc(max(price)) AS BIGINT), 0) AS max,
  coalesce(CAST(trunc(median(price)) AS BIGINT), 0) AS median
FROM {L} l WHERE lower(property_type) = 'building' AND lower(transaction_type) = 'o'""")
def q_price_range_two_filters(spark, sf):
    return se.price_range_of(listings(spark, sf), property_type="Building", transaction_type="o")


DEALS = ["F", "O"]


@query("options_summary", f"""
SELECT DISTINCT 'city' AS option, city AS value, NULL::BIGINT AS min, NULL::BIGINT AS max, NULL::BIGINT AS median FROM {L} a
UNION ALL SELECT DISTINCT 'property_type', property_type, NULL::BIGINT, NULL::BIGINT, NULL::BIGINT FROM {L} b
UNION ALL SELECT 'price', transaction_type, CAST(trunc(min(price)) AS BIGINT), CAST(trunc(max(price)) AS BIGINT),
  CAST(trunc(median(price)) AS BIGINT) FROM {L} c WHERE transaction_type IN ('F', 'O') GROUP BY transaction_type""")
def q_options_summary(spark, sf):
    return se.options(listings(spark, sf), DEALS)


@query("search_text_unicode", "SELECT doc_id, n_chars FROM documents WHERE regexp_matches(text, '(?i)ÉLLE|ÜNG|CIÓN')")
def q_search_text_unicode(spark, sf):
    """Case folding beyond ASCII, over documents as listings."""
    cols = {**se.DEFAULT_COLS, "district": "text", "price": "n_chars"}
    return se.search_filter(read_table(spark, sf, "documents"), se.Criteria(district="ÉLLE|ÜNG|CIÓN"), cols).select("doc_id", "n_chars")

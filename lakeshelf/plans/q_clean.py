"""Cleaning queries: projection of dotted names, tolerant and decimal casts,
constant fills, decodes (CASE and code-table join), flags, trimming,
schema conformance, and the whole silver chain."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshelf.operators import cleaning as cl
from lakeshelf.plans import silver
from lakeshelf.plans.q_profile import DOCS_LABELS_SQL, _docs_labels
from lakeshelf.plans.registry import query
from lakeshelf.plans.roles import RAW_LISTINGS_SQL, RENT_PERIODS, raw_listings
from lakeshelf.session import read_table
from lakeshelf.sources.io import code_table


@query("project_rename", """
SELECT c_custkey AS row_id, c_name AS user_name, c_acctbal AS user_review FROM customer""")
def q_project_rename(spark, sf):
    # customer shaped like a flattened JSON feed: dotted flat keys
    raw = read_table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("user.name"),
        F.col("c_acctbal").alias("user.review"), F.col("c_mktsegment").alias("segment"))
    return cl.project(raw, {"row_id": "id", "user_name": "user.name", "user_review": "user.review"})


@query("try_cast_cols", """
SELECT event_id, TRY_CAST(props AS INTEGER) AS props, TRY_CAST(CAST(value AS VARCHAR) AS DOUBLE) AS value,
       TRY_CAST(event_type AS INTEGER) AS event_type FROM events""")
def q_try_cast_cols(spark, sf):
    ev = read_table(spark, sf, "events").select(
        "event_id", "props", F.col("value").cast("string").alias("value"), "event_type")
    return cl.typed(ev, {"props": "int", "value": "double", "event_type": "int"})


@query("cast_rejects", """
SELECT count(*) FILTER (WHERE props IS NOT NULL AND TRY_CAST(props AS INTEGER) IS NULL) AS props_rejects,
       count(*) FILTER (WHERE value IS NOT NULL AND TRY_CAST(CAST(value AS VARCHAR) AS DOUBLE) IS NULL) AS value_rejects
FROM events""")
def q_cast_rejects(spark, sf):
    ev = read_table(spark, sf, "events").select("props", F.col("value").cast("string").alias("value"))
    return cl.cast_rejects(ev, {"props": "int", "value": "double"})


@query("decimal_cast", """
SELECT c_custkey, TRY_CAST(c_acctbal AS DECIMAL(10, 5)) AS c_acctbal FROM customer""")
def q_decimal_cast(spark, sf):
    c = read_table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return cl.typed(c, {"c_acctbal": T.DecimalType(10, 5)})


@query("fill_const", f"""
SELECT doc_id, lang, source, n_chars, coalesce(quality, 0) AS quality, coalesce(toxic, 0) AS toxic
FROM {DOCS_LABELS_SQL} x""")
def q_fill_const(spark, sf):
    df = _docs_labels(spark, sf).select("doc_id", "lang", "source", "n_chars", "quality", "toxic")
    return cl.fill_const(df, {"quality": 0, "toxic": 0})


@query("fill_strings", f"""
SELECT doc_id, lang, quality,
  coalesce(CASE quality WHEN 1 THEN 'good' WHEN 0 THEN 'poor' END, 'N/A') AS quality_text
FROM {DOCS_LABELS_SQL} x""")
def q_fill_strings(spark, sf):
    df = _docs_labels(spark, sf).select(
        "doc_id", "lang", "quality",
        F.when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor").alias("quality_text"))
    return cl.fill_strings(df, "N/A")


@query("decode_codes", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber IN (0, 3) THEN 'Yearly'
  WHEN l_linenumber = 1 THEN 'Daily' WHEN l_linenumber = 2 THEN 'Monthly' END AS rent_period
FROM lineitem""")
def q_decode_codes(spark, sf):
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return cl.decode(li, "l_linenumber", RENT_PERIODS, output="rent_period")


@query("flags_to_text", """
SELECT doc_id, CASE WHEN quality = 1 THEN 'Yes' WHEN quality = 0 THEN 'No' END AS is_quality,
       CASE WHEN toxic = 1 THEN 'Yes' WHEN toxic = 0 THEN 'No' END AS is_toxic FROM labels""")
def q_flags_to_text(spark, sf):
    lab = read_table(spark, sf, "labels")
    return cl.flags_to_text(lab, {"quality": "is_quality", "toxic": "is_toxic"})


@query("trim_normalize", "SELECT p_partkey, p_name FROM part")
def q_trim_normalize(spark, sf):
    p = read_table(spark, sf, "part").select(
        "p_partkey", F.concat(F.lit("  "), F.col("p_name"), F.lit(" \t")).alias("p_name"))
    return cl.trim_strings(p, ["p_name"])


_CODES_SQL = "(SELECT * FROM (VALUES " + ", ".join(
    f"({c}, '{p}', '{t}')" for c, p, t in silver.CATEGORY_CODES) + ") v(category_id, property_type, transaction_type))"


@query("decode_join", f"""
SELECT p.p_partkey, p.p_size, k.property_type, k.transaction_type
FROM part p LEFT JOIN {_CODES_SQL} k ON p.p_size = k.category_id""")
def q_decode_join(spark, sf):
    p = read_table(spark, sf, "part").select("p_partkey", "p_size")
    k = code_table(spark, silver.CATEGORY_CODES, silver.CATEGORY_COLUMNS)
    return (p.join(F.broadcast(k), p["p_size"] == k["category_id"], "left")
             .select("p_partkey", "p_size", "property_type", "transaction_type"))


CUSTOMER_CONFORM = T.StructType([
    T.StructField("user_id", T.LongType()), T.StructField("user_name", T.StringType()),
    T.StructField("user_review", T.FloatType()), T.StructField("location_lat", T.DecimalType(10, 5)),
    T.StructField("district_id", T.LongType()), T.StructField("is_active", T.IntegerType())])


@query("conform_schema", """
SELECT CAST(c_custkey AS BIGINT) AS user_id, c_name AS user_name, CAST(c_acctbal AS FLOAT) AS user_review,
  CAST(NULL AS DECIMAL(10, 5)) AS location_lat, CAST(c_nationkey AS BIGINT) AS district_id,
  CAST(NULL AS INTEGER) AS is_active FROM customer""")
def q_conform_schema(spark, sf):
    c = read_table(spark, sf, "customer")
    return cl.conform(c, CUSTOMER_CONFORM, rename={"user_id": "c_custkey", "user_name": "c_name",
                                                   "user_review": "c_acctbal", "district_id": "c_nationkey"})


@query("silver_clean", silver.clean_listings_sql(RAW_LISTINGS_SQL))
def q_silver_clean(spark, sf):
    return silver.clean_listings(raw_listings(spark, sf))

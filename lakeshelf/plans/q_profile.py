"""Profiling queries (frequencies, missing-value counts, extremes, grouped
averages, HAVING, distinct, filtered counts)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeshelf.operators import cleaning as cl
from lakeshelf.operators import profile as pr
from lakeshelf.plans.registry import query
from lakeshelf.session import read_table


def _docs_labels(spark, sf):
    d = read_table(spark, sf, "documents")
    lab = read_table(spark, sf, "labels")
    # labels grows with the data: no hint, AQE picks broadcast from runtime size
    return d.join(lab, "doc_id", "left")


DOCS_LABELS_SQL = "(SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"
_DL_COLS = ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"]


def _nan_lineitem(spark, sf):
    li = read_table(spark, sf, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_returnflag") == "R", F.lit(float("nan"))).otherwise(F.col("l_discount")).alias("disc"),
        F.when(F.col("l_linestatus") == "O", F.lit(None)).otherwise(F.col("l_tax")).alias("tax"),
    )


NAN_LINEITEM_SQL = """(SELECT l_orderkey, l_linenumber,
  CASE WHEN l_returnflag = 'R' THEN 'NaN'::DOUBLE ELSE l_discount END AS disc,
  CASE WHEN l_linestatus = 'O' THEN NULL ELSE l_tax END AS tax FROM lineitem)"""


@query("value_freq", """
SELECT l_suppkey, l_linenumber, count(*) AS freq FROM lineitem GROUP BY l_suppkey, l_linenumber""")
def q_value_freq(spark, sf):
    return pr.value_freq(read_table(spark, sf, "lineitem"), ["l_suppkey", "l_linenumber"])


@query("null_profile", " UNION ALL ".join(
    f"SELECT * FROM (SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM {DOCS_LABELS_SQL} x) WHERE null_count > 0"
    for c in _DL_COLS))
def q_null_profile(spark, sf):
    return pr.null_profile(_docs_labels(spark, sf))


@query("nan_null_profile", f"""
SELECT 'disc' AS column_name, count(*) FILTER (WHERE isnan(disc)) AS nan_count,
       count(*) FILTER (WHERE disc IS NULL) AS null_count FROM {NAN_LINEITEM_SQL} a
UNION ALL
SELECT 'tax', count(*) FILTER (WHERE isnan(tax)), count(*) FILTER (WHERE tax IS NULL) FROM {NAN_LINEITEM_SQL} b""")
def q_nan_null_profile(spark, sf):
    return pr.nan_null_counts(_nan_lineitem(spark, sf), ["disc", "tax"])


@query("drop_all_missing", f"""
SELECT l_orderkey, l_linenumber, CASE WHEN isnan(disc) THEN NULL ELSE disc END AS disc, tax
FROM {NAN_LINEITEM_SQL} x WHERE NOT ((disc IS NULL OR isnan(disc)) AND tax IS NULL)""")
def q_drop_all_missing(spark, sf):
    return cl.drop_all_missing(_nan_lineitem(spark, sf), ["disc", "tax"])


@query("min_max", """
SELECT min(l_shipdate) AS min_l_shipdate, max(l_shipdate) AS max_l_shipdate,
       min(l_extendedprice) AS min_l_extendedprice, max(l_extendedprice) AS max_l_extendedprice
FROM lineitem""")
def q_min_max(spark, sf):
    return pr.min_max(read_table(spark, sf, "lineitem"), ["l_shipdate", "l_extendedprice"])


@query("avg_by_group", """
SELECT l_suppkey, round(avg(l_extendedprice), 2) AS avg_l_extendedprice FROM lineitem GROUP BY l_suppkey""")
def q_avg_by_group(spark, sf):
    return pr.avg_by_group(read_table(spark, sf, "lineitem"), "l_suppkey", "l_extendedprice")


@query("group_having", """
SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 15""")
def q_group_having(spark, sf):
    return pr.group_having(read_table(spark, sf, "orders"), "o_custkey", 15)


@query("distinct_values", "SELECT DISTINCT c_mktsegment, c_nationkey FROM customer")
def q_distinct_values(spark, sf):
    return pr.distinct_values(read_table(spark, sf, "customer"), ["c_mktsegment", "c_nationkey"])


@query("filtered_count", """
SELECT count(*) AS total, count(*) FILTER (WHERE l_returnflag = 'R') AS returned,
       count(*) FILTER (WHERE l_quantity > 45) AS big FROM lineitem""")
def q_filtered_count(spark, sf):
    li = read_table(spark, sf, "lineitem")
    return pr.filtered_count(li, {"returned": F.col("l_returnflag") == "R", "big": F.col("l_quantity") > 45})


@query("nan_to_null", f"""
SELECT l_orderkey, l_linenumber, CASE WHEN isnan(disc) THEN NULL ELSE disc END AS disc, tax
FROM {NAN_LINEITEM_SQL} x""")
def q_nan_to_null(spark, sf):
    return cl.nan_to_null(_nan_lineitem(spark, sf))


@query("profile_bundle", """
WITH f AS (SELECT l_returnflag AS k, l_quantity AS m, l_linenumber FROM lineitem)
SELECT 'freq' AS part, k, CAST(count(*) AS DOUBLE) AS v FROM f GROUP BY k
UNION ALL SELECT 'distinct', k, NULL FROM f GROUP BY k
UNION ALL SELECT 'nulls', 'm', CAST(count(*) AS DOUBLE) FROM f WHERE l_linenumber = 3 HAVING count(*) > 0
UNION ALL SELECT 'min', NULL, min(m) FROM f WHERE l_linenumber <> 3 UNION ALL SELECT 'max', NULL, max(m) FROM f WHERE l_linenumber <> 3
UNION ALL SELECT 'avg', k, round(avg(m), 2) FROM f WHERE l_linenumber <> 3 GROUP BY k""")
def q_profile_bundle(spark, sf):
    """All parts of the exploration bundle as one long table."""
    li = read_table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("k"), F.when(F.col("l_linenumber") != 3, F.col("l_quantity")).alias("m"))
    p = pr.profile(li, "k", "m")
    none = F.lit(None).cast("string").alias("k")
    part = lambda name, df, key, v: df.select(F.lit(name).alias("part"), key, v.cast("double").alias("v"))
    out = part("nulls", p["nulls"], F.col("column_name").alias("k"), F.col("null_count"))
    for x in (part("freq", p["freq"], F.col("k"), F.col("freq")), part("distinct", p["distinct"], F.col("k"), F.lit(None)),
              part("min", p["min_max"], none, F.col("min_m")), part("max", p["min_max"], none, F.col("max_m")),
              part("avg", p["avg"], F.col("k"), F.col("avg_m"))):
        out = out.unionByName(x)
    return out

"""Role mapping of the driver's test tables onto the library's data model.

Each frame here has an SQL twin in ``registry`` (same expressions) so the
oracle sees the same input. Missing values are produced by rules on other
column values (never by dropping rows), because the test tables hold none.

* ``gappy_lineitem``: imputation input, group = supplier.
* ``listings``: the silver listing table — orders joined to customer,
  nation (district) and region (city); version = year(o_orderdate) - 1995.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshelf.functions.predicates import decode, flag_text
from lakeshelf.session import checked_broadcast, read_table

# Rent period codes (fixed values): 0 and 3 yearly, 1 daily, 2 monthly.
RENT_PERIODS = {(0, 3): "Yearly", 1: "Daily", 2: "Monthly"}

BASE_YEAR = 1995


def gappy_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_partkey", "l_suppkey",
        F.when(F.col("l_discount") == 0, None).otherwise(F.col("l_suppkey")).alias("grp"),
        F.when(F.col("l_returnflag") == "R", None)
         .otherwise(F.col("l_quantity").cast("int")).alias("qty"),
        F.when((F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "A"), None)
         .otherwise(F.col("l_linenumber")).alias("line"),
        F.when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F"), None)
         .otherwise(F.col("l_extendedprice")).alias("price"),
    )


GAPPY_LINEITEM_SQL = """(SELECT l_orderkey, l_partkey, l_suppkey,
  CASE WHEN l_discount = 0 THEN NULL ELSE l_suppkey END AS grp,
  CASE WHEN l_returnflag = 'R' THEN NULL ELSE CAST(l_quantity AS INTEGER) END AS qty,
  CASE WHEN l_linestatus = 'O' AND l_returnflag = 'A' THEN NULL ELSE l_linenumber END AS line,
  CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN NULL ELSE l_extendedprice END AS price
FROM lineitem)"""


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order, shaped like the silver listing table."""
    o = read_table(spark, sf_dir, "orders")
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    # nation and region are fixed-size reference tables (25 and 5 rows in
    # every scale factor); customer grows with the data and is size-checked.
    geo = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
    cust = c.join(F.broadcast(geo), c.c_nationkey == geo.n_nationkey)
    # customer grows with the data: broadcast only if its measured size
    # (rows and bytes of its text) is under the limit.
    cust = checked_broadcast(cust, stored=True)
    j = o.join(cust, o["o_custkey"] == cust["c_custkey"])
    k = F.col("o_orderkey")
    return j.select(
        k.alias("row_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("c_name").alias("user_name"),
        F.col("o_orderpriority").alias("advertiser_type"),
        F.when(F.col("c_acctbal") >= 0, "Yes").otherwise("No").alias("is_verified"),
        F.col("r_regionkey").cast("bigint").alias("city_id"),
        F.col("r_name").alias("city"),
        F.col("n_nationkey").cast("bigint").alias("district_id"),
        F.col("n_name").alias("district"),
        F.col("c_mktsegment").alias("property_type"),
        F.col("o_orderstatus").alias("transaction_type"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_totalprice").alias("price"),
        flag_text(k % 2).alias("has_air_condition"),
        flag_text((k % 3 == 0).cast("int")).alias("has_kitchen"),
        flag_text(F.col("o_custkey") % 2).alias("has_furnished"),
        flag_text((k % 5 == 0).cast("int")).alias("is_daily_rentable"),
        decode(k % 4, RENT_PERIODS).alias("rent_period"),
        (F.col("o_custkey") % 5 + 1).cast("int").alias("bedrooms"),
        (k % 4 + 1).cast("int").alias("bathrooms"),
        (k % 3).cast("int").alias("livings"),
        (k % 40).cast("int").alias("age"),
        (F.col("o_totalprice") / 100).alias("area"),
        (F.year("o_orderdate") - BASE_YEAR).alias("_commit_version"),
    )


LISTINGS_SQL = """(SELECT o.o_orderkey AS row_id, o.o_custkey AS user_id, c.c_name AS user_name,
  o.o_orderpriority AS advertiser_type,
  CASE WHEN c.c_acctbal >= 0 THEN 'Yes' ELSE 'No' END AS is_verified,
  CAST(r.r_regionkey AS BIGINT) AS city_id, r.r_name AS city,
  CAST(n.n_nationkey AS BIGINT) AS district_id, n.n_name AS district,
  c.c_mktsegment AS property_type, o.o_orderstatus AS transaction_type,
  o.o_orderdate AS created_at, o.o_totalprice AS price,
  CASE o.o_orderkey % 2 WHEN 1 THEN 'Yes' WHEN 0 THEN 'No' END AS has_air_condition,
  CASE WHEN o.o_orderkey % 3 = 0 THEN 'Yes' ELSE 'No' END AS has_kitchen,
  CASE o.o_custkey % 2 WHEN 1 THEN 'Yes' WHEN 0 THEN 'No' END AS has_furnished,
  CASE WHEN o.o_orderkey % 5 = 0 THEN 'Yes' ELSE 'No' END AS is_daily_rentable,
  CASE WHEN o.o_orderkey % 4 IN (0, 3) THEN 'Yearly' WHEN o.o_orderkey % 4 = 1 THEN 'Daily'
       WHEN o.o_orderkey % 4 = 2 THEN 'Monthly' END AS rent_period,
  CAST(o.o_custkey % 5 + 1 AS INTEGER) AS bedrooms, CAST(o.o_orderkey % 4 + 1 AS INTEGER) AS bathrooms,
  CAST(o.o_orderkey % 3 AS INTEGER) AS livings, CAST(o.o_orderkey % 40 AS INTEGER) AS age,
  o.o_totalprice / 100 AS area,
  CAST(year(o.o_orderdate) - 1995 AS INTEGER) AS _commit_version
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey)"""


def raw_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze-shaped listings: text fields as a raw JSON feed would carry them
    (dotted flat keys, codes as text, 'NaN' and '' as bad values, NULLs),
    derived by rules from orders, customer, nation and region."""
    o = read_table(spark, sf_dir, "orders")
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    geo = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
    cust = c.join(F.broadcast(geo), c.c_nationkey == geo.n_nationkey)
    # customer grows with the data: broadcast only if its measured size
    # (rows and bytes of its text) is under the limit.
    cust = checked_broadcast(cust, stored=True)
    j = o.join(cust, o["o_custkey"] == cust["c_custkey"])
    k, ck = F.col("o_orderkey"), F.col("o_custkey")
    st, pri, seg = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("c_mktsegment")
    txt = lambda e: e.cast("string")
    return j.select(
        txt(k).alias("id"),
        ck.alias("user_id"),
        F.col("c_name").alias("user.name"),
        F.when(F.col("c_acctbal") < 0, "NaN").when(F.col("c_acctbal") < 5000, "1")
         .otherwise("0").alias("user.iam_verified"),
        F.when(st == "P", None).otherwise(F.col("c_acctbal") / 1000).alias("user.review"),
        F.concat(txt(F.col("n_nationkey")), F.lit(".25")).alias("location.lat"),
        F.concat(txt(F.col("r_regionkey")), F.lit(".75")).alias("location.lng"),
        F.col("o_orderdate").alias("create_time"),
        F.col("o_orderdate").alias("createdAt"),
        # edited up to 400 days later, so that newest by update is not newest by creation
        F.date_add(F.col("o_orderdate").cast("date"), ((7 * ck + k) % 400).cast("int")).alias("updatedAt"),
        F.when(pri == "5-LOW", None).otherwise(txt(k % 40)).alias("age"),
        F.when(pri == "4-NOT SPECIFIED", "NaN").otherwise(txt(k % 2)).alias("ac"),
        F.when(seg == "BUILDING", None).otherwise(txt(ck % 2)).alias("ketchen"),
        F.when(st == "P", "").otherwise(txt(k % 4 + 1)).alias("wc"),
        F.when(seg == "MACHINERY", None).otherwise(txt(ck % 5 + 1)).alias("beds"),
        F.when(pri == "2-HIGH", "NaN").otherwise(txt(k % 3)).alias("livings"),
        F.when(seg == "HOUSEHOLD", None).otherwise(txt((ck + 1) % 2)).alias("furnished"),
        F.when((st == "F") & (pri == "3-MEDIUM"), None).otherwise(txt(k % 4)).alias("rent_period"),
        F.when((st == "P") & (pri == "1-URGENT"), None)
         .otherwise(txt((k % 5 == 0).cast("int"))).alias("daily_rentable"),
        F.col("o_totalprice").alias("price"),
        (k % 24).cast("int").alias("category"),
        F.when(st == "P", None).otherwise(F.col("o_totalprice") / 100).alias("area"),
        F.col("r_name").alias("city"),
        F.col("n_name").alias("district"),
        F.when((st == "O") & (pri == "5-LOW"), None).otherwise(pri).alias("advertiser_type"),
        F.col("r_regionkey").cast("bigint").alias("city_id"),
        F.col("n_nationkey").cast("bigint").alias("district_id"),
    )


RAW_LISTINGS_SQL = """(SELECT CAST(o.o_orderkey AS VARCHAR) AS id, o.o_custkey AS user_id,
  c.c_name AS "user.name",
  CASE WHEN c.c_acctbal < 0 THEN 'NaN' WHEN c.c_acctbal < 5000 THEN '1' ELSE '0' END AS "user.iam_verified",
  CASE WHEN o.o_orderstatus = 'P' THEN NULL ELSE c.c_acctbal / 1000 END AS "user.review",
  CAST(n.n_nationkey AS VARCHAR) || '.25' AS "location.lat",
  CAST(r.r_regionkey AS VARCHAR) || '.75' AS "location.lng",
  o.o_orderdate AS create_time, o.o_orderdate AS "createdAt", CAST(o.o_orderdate AS DATE) + CAST((7 * o.o_custkey + o.o_orderkey) % 400 AS INTEGER) AS "updatedAt",
  CASE WHEN o.o_orderpriority = '5-LOW' THEN NULL ELSE CAST(o.o_orderkey % 40 AS VARCHAR) END AS age,
  CASE WHEN o.o_orderpriority = '4-NOT SPECIFIED' THEN 'NaN' ELSE CAST(o.o_orderkey % 2 AS VARCHAR) END AS ac,
  CASE WHEN c.c_mktsegment = 'BUILDING' THEN NULL ELSE CAST(o.o_custkey % 2 AS VARCHAR) END AS ketchen,
  CASE WHEN o.o_orderstatus = 'P' THEN '' ELSE CAST(o.o_orderkey % 4 + 1 AS VARCHAR) END AS wc,
  CASE WHEN c.c_mktsegment = 'MACHINERY' THEN NULL ELSE CAST(o.o_custkey % 5 + 1 AS VARCHAR) END AS beds,
  CASE WHEN o.o_orderpriority = '2-HIGH' THEN 'NaN' ELSE CAST(o.o_orderkey % 3 AS VARCHAR) END AS livings,
  CASE WHEN c.c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE CAST((o.o_custkey + 1) % 2 AS VARCHAR) END AS furnished,
  CASE WHEN o.o_orderstatus = 'F' AND o.o_orderpriority = '3-MEDIUM' THEN NULL
       ELSE CAST(o.o_orderkey % 4 AS VARCHAR) END AS rent_period,
  CASE WHEN o.o_orderstatus = 'P' AND o.o_orderpriority = '1-URGENT' THEN NULL
       ELSE CAST(CAST(o.o_orderkey % 5 = 0 AS INTEGER) AS VARCHAR) END AS daily_rentable,
  o.o_totalprice AS price, CAST(o.o_orderkey % 24 AS INTEGER) AS category,
  CASE WHEN o.o_orderstatus = 'P' THEN NULL ELSE o.o_totalprice / 100 END AS area,
  r.r_name AS city, n.n_name AS district,
  CASE WHEN o.o_orderstatus = 'O' AND o.o_orderpriority = '5-LOW' THEN NULL ELSE o.o_orderpriority END AS advertiser_type,
  CAST(r.r_regionkey AS BIGINT) AS city_id, CAST(n.n_nationkey AS BIGINT) AS district_id
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey)"""

"""Dimension queries: de-duplication, surrogate keys, calendar,
insert-only upserts over two change batches, type-2 history."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeshelf.operators import dims as dm
from lakeshelf.plans.registry import query
from lakeshelf.plans.roles import LISTINGS_SQL as L
from lakeshelf.plans.roles import listings
from lakeshelf.session import read_table

# Change batches of the listing table: A = versions 0..2, B = versions 3 and up.
SPLIT_VERSION = 2
LATEST = ["created_at", "row_id"]


def _batches(spark, sf):
    li = listings(spark, sf)
    return li.where(F.col("_commit_version") <= SPLIT_VERSION), li.where(F.col("_commit_version") > SPLIT_VERSION)


def _latest_sql(cols: str, where: str) -> str:
    return f"""(SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY user_id
  ORDER BY created_at DESC, row_id DESC) AS rn FROM {L} l WHERE {where}) WHERE rn = 1)"""


def _empty(spark, schema: str):
    return spark.createDataFrame([], schema)


@query("dedup_latest", """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1""")
def q_dedup_latest(spark, sf):
    ev = read_table(spark, sf, "events")
    return dm.dedup_latest(ev, ["user_id"], ["ts", "event_id"])


@query("dedup_multi", "SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def q_dedup_multi(spark, sf):
    return dm.dedup_rows(read_table(spark, sf, "orders"), ["o_custkey", "o_orderstatus"])


_LI_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
             "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


@query("dedup_first", f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
       l_tax, l_returnflag, l_linestatus, l_shipdate FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(_LI_ORDER)}) AS rn
  FROM lineitem) WHERE rn = 1""")
def q_dedup_first(spark, sf):
    return dm.dedup_first(read_table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], _LI_ORDER)


@query("surrogate_keys", """
SELECT row_number() OVER (ORDER BY l_partkey) AS id, l_partkey
FROM (SELECT DISTINCT l_partkey FROM lineitem)""")
def q_surrogate_keys(spark, sf):
    keys = read_table(spark, sf, "lineitem").select("l_partkey").distinct()
    return dm.with_surrogate_key(keys, ["l_partkey"])


@query("date_dim", """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS date,
  CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
  CAST(quarter(d) AS INTEGER) AS quarter, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week,
  CASE WHEN dayofweek(d) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend
FROM (SELECT CAST(unnest(generate_series(CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE),
      INTERVAL 1 DAY)) AS DATE) AS d FROM orders)""")
def q_date_dim(spark, sf):
    o = read_table(spark, sf, "orders")
    bounds = o.agg(F.min("o_orderdate").cast("date").alias("s"), F.max("o_orderdate").cast("date").alias("e"))
    return dm.date_dim(spark, F.col("s"), F.col("e"), source=bounds)


USERS_SCHEMA = "id bigint, user_id bigint, user_name string"


@query("upsert_insert_only_1key", f"""
WITH a AS {_latest_sql('user_id, user_name', f'_commit_version <= {SPLIT_VERSION}')},
b AS {_latest_sql('user_id, user_name', f'_commit_version > {SPLIT_VERSION}')},
d1 AS (SELECT CAST(row_number() OVER (ORDER BY user_id NULLS LAST) AS BIGINT) AS id, user_id, user_name FROM a),
n AS (SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM d1 WHERE d1.user_id = b.user_id))
SELECT * FROM d1 UNION ALL
SELECT (SELECT coalesce(max(id), 0) FROM d1) + row_number() OVER (ORDER BY user_id NULLS LAST), user_id, user_name FROM n""")
def q_upsert_1key(spark, sf):
    a, b = _batches(spark, sf)
    d0 = _empty(spark, USERS_SCHEMA)
    d1 = dm.upsert_dim(d0, a, ["user_id"], ["user_name"], order=LATEST)
    return dm.upsert_dim(d1, b, ["user_id"], ["user_name"], order=LATEST)


def _multi_key_sql(keys: list[str]) -> str:
    k = ", ".join(keys)
    ks = ", ".join(f"{c} NULLS LAST" for c in keys)
    eq = " AND ".join(f"d1.{c} = b.{c}" for c in keys)
    return f"""
WITH a AS (SELECT DISTINCT {k} FROM {L} l WHERE _commit_version <= {SPLIT_VERSION}),
b AS (SELECT DISTINCT {k} FROM {L} l WHERE _commit_version > {SPLIT_VERSION}),
d1 AS (SELECT CAST(row_number() OVER (ORDER BY {ks}) AS BIGINT) AS id, {k} FROM a),
n AS (SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM d1 WHERE {eq}))
SELECT * FROM d1 UNION ALL
SELECT (SELECT coalesce(max(id), 0) FROM d1) + row_number() OVER (ORDER BY {ks}), {k} FROM n"""


CATEGORY_KEYS = ["property_type", "transaction_type"]
FEATURE_KEYS = ["has_air_condition", "has_kitchen", "has_furnished", "is_daily_rentable", "rent_period"]


def _two_runs(spark, sf, keys):
    a, b = _batches(spark, sf)
    d0 = _empty(spark, "id bigint, " + ", ".join(f"{k} string" for k in keys))
    d1 = dm.upsert_dim(d0, a, keys)
    return dm.upsert_dim(d1, b, keys)


@query("upsert_insert_only_2key", _multi_key_sql(CATEGORY_KEYS))
def q_upsert_2key(spark, sf):
    return _two_runs(spark, sf, CATEGORY_KEYS)


@query("upsert_insert_only_5key", _multi_key_sql(FEATURE_KEYS))
def q_upsert_5key(spark, sf):
    return _two_runs(spark, sf, FEATURE_KEYS)


@query("new_keys_anti", """
SELECT c_custkey, c_name FROM customer c WHERE NOT EXISTS (
  SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey)""")
def q_new_keys_anti(spark, sf):
    """Customers without an order (anti join, not left join + IS NULL)."""
    c = read_table(spark, sf, "customer").select("c_custkey", "c_name")
    o = read_table(spark, sf, "orders").select("o_custkey")
    return c.join(o, c.c_custkey == o.o_custkey, "left_anti")


USER_TRACKED = ["user_name", "advertiser_type", "is_verified"]
SCD_SCHEMA = "id bigint, user_id bigint, user_name string, advertiser_type string, is_verified string, is_active int"
_UT = ", ".join(USER_TRACKED)

SCD2_SQL = f"""
WITH a AS {_latest_sql('user_id, ' + _UT, f'_commit_version <= {SPLIT_VERSION}')},
b AS {_latest_sql('user_id, ' + _UT, f'_commit_version > {SPLIT_VERSION}')},
d1 AS (SELECT CAST(row_number() OVER (ORDER BY user_id NULLS LAST) AS BIGINT) AS id, user_id, {_UT},
              1 AS is_active FROM a),
upd AS (SELECT d1.id, d1.user_id, d1.user_name, d1.advertiser_type, d1.is_verified,
  CASE WHEN d1.is_active = 1 AND b.user_id IS NOT NULL AND (d1.user_name <> b.user_name
       OR d1.advertiser_type <> b.advertiser_type OR d1.is_verified <> b.is_verified)
  THEN 0 ELSE d1.is_active END AS is_active
  FROM d1 LEFT JOIN b ON d1.user_id = b.user_id),
n AS (SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM upd WHERE upd.is_active = 1 AND upd.user_id = b.user_id))
SELECT * FROM upd UNION ALL
SELECT (SELECT max(id) FROM upd) + row_number() OVER (ORDER BY user_id NULLS LAST), user_id, {_UT}, 1 FROM n"""


def _scd_runs(spark, sf, repeat_b: int):
    a, b = _batches(spark, sf)
    d0 = _empty(spark, SCD_SCHEMA)
    dim = dm.scd2(d0, a, "user_id", USER_TRACKED, order=LATEST)
    for _ in range(repeat_b):
        dim = dm.scd2(dim, b, "user_id", USER_TRACKED, order=LATEST)
    return dim


@query("scd2_users", SCD2_SQL)
def q_scd2_users(spark, sf):
    return _scd_runs(spark, sf, 1)


@query("scd2_second_run", SCD2_SQL)
def q_scd2_second_run(spark, sf):
    """Applying the same batch again changes nothing."""
    return _scd_runs(spark, sf, 2)


@query("date_dim_extend", """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS date,
  CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
  CAST(quarter(d) AS INTEGER) AS quarter, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week,
  CASE WHEN dayofweek(d) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend
FROM (SELECT CAST(unnest(generate_series(CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE),
      INTERVAL 1 DAY)) AS DATE) AS d FROM orders)""")
def q_date_dim_extend(spark, sf):
    """A calendar that stops 30 days before the newest order is extended up
    to that day ("today" = newest order date); written, then appended."""
    from lakeshelf.session import materialize
    o = read_table(spark, sf, "orders")
    bounds = o.agg(F.min("o_orderdate").cast("date").alias("s"),
                   F.date_sub(F.max("o_orderdate").cast("date"), 30).alias("e"))
    old = materialize(dm.date_dim(spark, F.col("s"), F.col("e"), source=bounds), "dim_dates")
    today = o.agg(F.max("o_orderdate").cast("date")).first()[0]
    return old.unionByName(dm.extend_date_dim(old, today))


@query("limit_n", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def q_limit_n(spark, sf):
    """Top-10 report (the limit is the feature): TakeOrderedAndProject keeps
    10 rows per partition, never a global sort."""
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return o.orderBy(F.desc("o_totalprice"), F.asc("o_orderkey")).limit(10)


@query("scd2_bucketed", SCD2_SQL)
def q_scd2_bucketed(spark, sf):
    """The two SCD2 batches applied to a stored, bucketed dimension: each reads
    only the buckets its delta touches and publishes new runs of them."""
    from lakeshelf.session import scratch_path
    path = scratch_path(spark, "dim_users")
    a, b = _batches(spark, sf)
    for batch in (a, b):
        dm.scd2_in_place(path, batch, "user_id", USER_TRACKED, SCD_SCHEMA, buckets=16, order=LATEST)
    return dm.read_dim(spark, path, SCD_SCHEMA)

"""Source/sink queries. Each writes through the shared scratch folder
(``spark.checkpoint.dir``) and returns the re-read table, so the result
checks the round trip, not the input."""

from __future__ import annotations

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from lakeshelf.plans.registry import query
from lakeshelf.plans.roles import LISTINGS_SQL, listings
from lakeshelf.session import read_table, scratch_path
from lakeshelf.sources import history, io, state

AS_OF = dt.datetime(2024, 3, 7, 9, 30)  # fixed ingestion time: reruns write the same folders


@query("scan_layer", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'""")
def q_scan_layer(spark, sf):
    """Layer-addressed scan; the filter and the 3-column projection reach the
    parquet reader (PushedFilters / ReadSchema)."""
    root, layer = os.path.split(sf.rstrip("/"))
    o = io.read_layer(spark, root, layer, "orders.parquet")
    return o.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey", "o_totalprice")


@query("json_roundtrip", """
SELECT c_custkey, c_name, c_acctbal, c_mktsegment, c_nationkey FROM customer""")
def q_json_roundtrip(spark, sf):
    path = scratch_path(spark, "json")
    read_table(spark, sf, "customer").write.partitionBy("c_nationkey").json(path)
    back = io.read_json_partitioned(spark, path)  # inferred; c_nationkey from the folders
    return back.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment", "c_nationkey")


@query("csv_roundtrip", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def q_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "csv")
    read_table(spark, sf, "part").write.option("header", True).csv(path)
    back = io.read_csv(spark, path)  # header + inferred types
    return back.select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")


MANIFEST = [
    {"relative_path": "orders.parquet", "container_name": "raw", "folder_destination": "posts",
     "file_destination": "posts"},
    {"relative_path": "customer.parquet", "container_name": "raw", "folder_destination": "users",
     "file_destination": "users"},
]


@query("ingest_partitioned", f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
  {AS_OF.year} AS year, {AS_OF.month} AS month, {AS_OF.day} AS day FROM orders""")
def q_ingest_partitioned(spark, sf):
    """Manifest (a JSON array file) -> dated bronze folders -> partitioned
    JSON read; year/month/day come back as integer partition columns."""
    mpath = scratch_path(spark, "manifest")
    state.write_text(spark, f"{mpath}/param.json", json.dumps(MANIFEST))  # one JSON array file
    entries = [r.asDict() for r in io.read_manifest(spark, mpath).collect()]  # a few config rows
    dst = scratch_path(spark, "bronze")
    io.ingest(spark, entries, sf, dst, AS_OF)
    posts = io.read_json_partitioned(
        spark, f"{dst}/raw/posts",
        schema="o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderpriority string, year int, month int, day int")
    return posts.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority",
                        "year", "month", "day")


@query("ingest_two_containers", """
SELECT 'raw' AS container, o_orderkey AS key, o_totalprice AS amount FROM orders
UNION ALL SELECT 'curated', c_custkey, c_acctbal FROM customer""")
def q_ingest_two_containers(spark, sf):
    """Two entries with the same folder and file in different containers;
    both copies are read back."""
    dst = scratch_path(spark, "bronze")
    io.ingest(spark, [
        {"relative_path": "orders.parquet", "container_name": "raw", "folder_destination": "feed", "file_destination": "rows"},
        {"relative_path": "customer.parquet", "container_name": "curated", "folder_destination": "feed", "file_destination": "rows"}],
        sf, dst, AS_OF)
    part = lambda c, schema, k, v: io.read_json_partitioned(spark, f"{dst}/{c}/feed", schema=schema).select(
        F.lit(c).alias("container"), F.col(k).alias("key"), F.col(v).alias("amount"))
    return part("raw", "o_orderkey bigint, o_totalprice double", "o_orderkey", "o_totalprice").unionByName(
        part("curated", "c_custkey bigint, c_acctbal double", "c_custkey", "c_acctbal"))


@query("catalog_scan", "SELECT s_suppkey, s_nationkey, s_acctbal FROM supplier WHERE s_acctbal > 0")
def q_catalog_scan(spark, sf):
    """A registered table read by name; filter and columns reach its files."""
    read_table(spark, sf, "supplier").createOrReplaceTempView("lakeshelf_supplier")
    t = io.read_layer(spark, "", "", "lakeshelf_supplier", fmt="table")
    return t.where(F.col("s_acctbal") > 0).select("s_suppkey", "s_nationkey", "s_acctbal")


@query("latest_partition", """
SELECT max(strftime(CAST(ts AS DATE), '%Y%m%d')) AS max_ingestion FROM events""")
def q_latest_partition(spark, sf):
    """Folder names of a table partitioned by date; no file is opened."""
    path = scratch_path(spark, "dated")
    ev = read_table(spark, sf, "events").select(
        "event_id", F.year("ts").alias("year"), F.month("ts").alias("month"), F.dayofmonth("ts").alias("day"))
    ev.hint("rebalance", "year", "month", "day").write.partitionBy("year", "month", "day").parquet(path)
    return io.newest_date(spark, path)


@query("latest_scanned", """
SELECT max(strftime(CAST(o_orderdate AS DATE), '%Y%m%d')) AS max_ingestion FROM orders""")
def q_latest_scanned(spark, sf):
    o = read_table(spark, sf, "orders").select(
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"),
        F.dayofmonth("o_orderdate").alias("day"))
    return io.latest_partition(o)


def _versioned_listings(spark, sf):
    path = scratch_path(spark, "listings")
    io.append_version(listings(spark, sf), path)
    return io.read_versions(spark, path)


_LCOLS = ("row_id, user_id, user_name, advertiser_type, is_verified, city_id, city, district_id, "
          "district, property_type, transaction_type, created_at, price, has_air_condition, has_kitchen, "
          "has_furnished, is_daily_rentable, rent_period, _commit_version")


@query("append_versions", f"SELECT {_LCOLS} FROM {LISTINGS_SQL} l")
def q_append_versions(spark, sf):
    t = _versioned_listings(spark, sf)
    return t.select(*[c.strip() for c in _LCOLS.split(",")])


@query("append_replay", f"SELECT {_LCOLS} FROM {LISTINGS_SQL} l")
def q_append_replay(spark, sf):
    """Writing a version twice replaces it: no duplicates after a replay."""
    path = scratch_path(spark, "listings")
    li = listings(spark, sf)
    io.append_version(li, path)
    io.append_version(li.where(F.col("_commit_version") == 3), path)  # replay of version 3
    return io.read_versions(spark, path).select(*[c.strip() for c in _LCOLS.split(",")])


@query("table_history", f"""
SELECT DISTINCT CAST(0 AS BIGINT) AS seq, 'WRITE' AS operation, _commit_version AS version FROM {LISTINGS_SQL} a WHERE _commit_version <= 3
UNION ALL SELECT DISTINCT 1, 'WRITE', _commit_version FROM {LISTINGS_SQL} b WHERE _commit_version > 3
UNION ALL SELECT DISTINCT 2, 'REPLACE', _commit_version FROM {LISTINGS_SQL} c WHERE _commit_version = 3""")
def q_table_history(spark, sf):
    """What three writes did to a table: two of new versions, a replay."""
    path = scratch_path(spark, "listings")
    li = listings(spark, sf)
    io.append_version(li.where(F.col("_commit_version") <= 3), path)
    io.append_version(li.where(F.col("_commit_version") > 3), path)
    io.append_version(li.where(F.col("_commit_version") == 3), path)
    return history.history(spark, path).select("seq", "operation", "version")


@query("table_as_of", f"SELECT {_LCOLS} FROM {LISTINGS_SQL} l WHERE _commit_version <= 2")
def q_table_as_of(spark, sf):
    """The table as it was after its first write."""
    path = scratch_path(spark, "listings")
    li = listings(spark, sf)
    io.append_version(li.where(F.col("_commit_version") <= 2), path)
    io.append_version(li.where(F.col("_commit_version") > 2), path)
    return history.read_as_of(spark, path, 0).select(*[c.strip() for c in _LCOLS.split(",")])


@query("changes_since", f"SELECT {_LCOLS} FROM {LISTINGS_SQL} l WHERE _commit_version > 2 AND _commit_version <= 5")
def q_changes_since(spark, sf):
    t = _versioned_listings(spark, sf)
    return io.read_changes(t, since=2, until=5).select(*[c.strip() for c in _LCOLS.split(",")])


@query("current_version", f"SELECT max(_commit_version) AS current_version FROM {LISTINGS_SQL} l")
def q_current_version(spark, sf):
    path = scratch_path(spark, "listings")
    io.append_version(listings(spark, sf), path)
    return io.current_version(spark, path)


@query("state_marks", f"""
SELECT * FROM (VALUES ('comments', '{state.BRONZE_SEED}')) s(table_name, mark)
UNION ALL SELECT 'posts', max(strftime(CAST(o_orderdate AS DATE), '%Y%m%d')) FROM orders
UNION ALL SELECT 'fact_posts', CAST(max(_commit_version) AS VARCHAR) FROM {LISTINGS_SQL} l
UNION ALL SELECT * FROM (VALUES ('dim_users', '{state.GOLD_SEED}')) g(table_name, mark)""")
def q_state_marks(spark, sf):
    """Seed bronze and gold marks, then move two of them to values read from
    the data (newest ingestion date, newest listing version)."""
    root = scratch_path(spark, "state")
    state.seed_marks(spark, root, ["comments", "posts"], state.BRONZE_SEED)
    state.seed_marks(spark, root, ["dim_users", "fact_posts"], state.GOLD_SEED)
    o = read_table(spark, sf, "orders").select(
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"),
        F.dayofmonth("o_orderdate").alias("day"))
    newest = io.latest_partition(o).first()[0]
    if state.if_newer(state.get_mark(spark, root, "posts"), newest):
        state.set_mark(spark, root, "posts", newest)
    path = scratch_path(spark, "listings")
    io.append_version(listings(spark, sf), path)
    state.run_step(spark, root, "fact_posts", io.latest_version(spark, path), lambda since, until: None)
    return state.read_state(spark, root)

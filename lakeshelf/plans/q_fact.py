"""Gold queries: star key resolution, the flagship city/month report and a
two-run incremental load of the silver table."""

from __future__ import annotations

import functools
import os

from pyspark.sql import functions as F

from lakeshelf.operators.facts import incremental, incremental_steps
from lakeshelf.plans import gold, silver
from lakeshelf.plans.registry import query
from lakeshelf.plans.roles import RAW_LISTINGS_SQL, raw_listings
from lakeshelf.session import materialize, read_table, scratch_path
from lakeshelf.sources import io

S = silver.clean_listings_sql(RAW_LISTINGS_SQL)


def _ids(keys):
    k = ", ".join(keys)
    order = ", ".join(f"{c} NULLS LAST" for c in keys)
    return f"(SELECT CAST(row_number() OVER (ORDER BY {order}) AS BIGINT) AS id, {k} FROM (SELECT DISTINCT {k} FROM s))"


FACT_SQL = f"""WITH s AS ({S}),
u AS {_ids(['user_id'])}, ci AS {_ids(['city_id'])}, di AS {_ids(['district_id'])},
ca AS {_ids(gold.CATEGORY_KEYS)}, fe AS {_ids(gold.FEATURE_KEYS)}
SELECT s.row_id, u.id AS user_id, ci.id AS city_id, di.id AS district_id,
  CAST(strftime(CAST(s.created_at AS DATE), '%Y%m%d') AS INTEGER) AS date_id,
  ca.id AS category_id, fe.id AS property_feature_id,
  {', '.join('s.' + m for m in gold.FACT_MEASURES)}
FROM s LEFT JOIN u ON u.user_id = s.user_id LEFT JOIN ci ON ci.city_id = s.city_id
LEFT JOIN di ON di.district_id = s.district_id
LEFT JOIN ca ON {' AND '.join(f'ca.{k} = s.{k}' for k in gold.CATEGORY_KEYS)}
LEFT JOIN fe ON {' AND '.join(f'fe.{k} = s.{k}' for k in gold.FEATURE_KEYS)}"""


def _gold(spark, sf):
    slv = materialize(silver.clean_listings(raw_listings(spark, sf)), "silver")
    dims = gold.build_dims(slv)
    return slv, dims, gold.build_fact(slv, dims)


@query("fact_resolve_keys", FACT_SQL)
def q_fact_resolve_keys(spark, sf):
    return _gold(spark, sf)[2]


@query("fact_city_month", f"""WITH f AS ({FACT_SQL}), s AS ({S}),
ci AS {_ids(['city_id'])}
SELECT c.city, CAST(f.date_id / 10000 AS INTEGER) AS year, CAST(f.date_id / 100 % 100 AS INTEGER) AS month,
  count(*) AS listings, round(avg(f.price), 2) AS avg_price
FROM f LEFT JOIN (SELECT ci.id, s1.city FROM ci JOIN (SELECT DISTINCT city_id, city FROM s) s1
  ON ci.city_id = s1.city_id) c ON f.city_id = c.id
GROUP BY 1, 2, 3""")
def q_fact_city_month(spark, sf):
    _, dims, fact = _gold(spark, sf)
    return gold.city_month_report(fact, dims)


def _batch_sql(cond: str, version: int) -> str:
    raw = f"(SELECT * FROM {RAW_LISTINGS_SQL} r0 WHERE {cond})"
    return f"SELECT *, {version} AS _commit_version FROM ({silver.clean_listings_sql(raw)}) b{version}"


@query("incremental_two_runs",
       _batch_sql("year(create_time) - 1995 <= 2", 2) + "\nUNION ALL\n" + _batch_sql("year(create_time) - 1995 > 2", 6))
def q_incremental_two_runs(spark, sf):
    """Bronze versions 0..6 (one per listing year). Run 1 sees versions up
    to 2, run 2 the rest, run 3 finds nothing new and is skipped by the
    gate. Group lookups are computed per change set, as each run would."""
    root = scratch_path(spark, "incr")
    bronze, target, marks = (os.path.join(root, p) for p in ("bronze", "silver", "state"))
    raw = raw_listings(spark, sf)
    io.append_version(raw.withColumn(io.VERSION, F.year("createdAt") - 1995), bronze)
    step = functools.partial(silver.clean_listings, dedup=True)  # one row per listing per change set
    ran = [incremental(spark, marks, "silver_posts", bronze, target, step, until=2),
           incremental(spark, marks, "silver_posts", bronze, target, step),
           incremental(spark, marks, "silver_posts", bronze, target, step)]
    if ran != [True, True, False]:
        raise RuntimeError(f"unexpected gate decisions {ran}")
    return io.read_versions(spark, target)


def _upsert_sql(name: str, keys: list[str], a: str, b: str) -> str:
    k = ", ".join(keys)
    order = ", ".join(f"{c} NULLS LAST" for c in keys)
    eq = " AND ".join(f"x.{c} = y.{c}" for c in keys)
    return f"""{name}1 AS (SELECT CAST(row_number() OVER (ORDER BY {order}) AS BIGINT) AS id, {k}
  FROM (SELECT DISTINCT {k} FROM {a}) q),
{name}2 AS (SELECT * FROM {name}1 UNION ALL
  SELECT (SELECT coalesce(max(id), 0) FROM {name}1) + row_number() OVER (ORDER BY {order}), {k}
  FROM (SELECT DISTINCT {k} FROM {b} y WHERE NOT EXISTS (SELECT 1 FROM {name}1 x WHERE {eq})) q)"""


def _users_sql() -> str:
    tr = gold.USER_TRACKED
    cols = ", ".join(tr)
    latest = lambda src: (f"(SELECT user_id, {cols} FROM (SELECT *, row_number() OVER (PARTITION BY user_id "  # noqa: E731
                          f"ORDER BY updated_at DESC, created_at DESC, row_id DESC) AS rn FROM {src}) WHERE rn = 1)")
    diff = " OR ".join(f"u1.{c} <> ub.{c}" for c in tr)
    return f"""ua AS {latest('sa')}, ub AS {latest('sb')},
u1 AS (SELECT CAST(row_number() OVER (ORDER BY user_id NULLS LAST) AS BIGINT) AS id, user_id, {cols},
  1 AS is_active FROM ua),
uu AS (SELECT u1.id, u1.user_id, {', '.join('u1.' + c for c in tr)},
  CASE WHEN u1.is_active = 1 AND ub.user_id IS NOT NULL AND ({diff}) THEN 0 ELSE u1.is_active END AS is_active
  FROM u1 LEFT JOIN ub ON u1.user_id = ub.user_id),
u2 AS (SELECT * FROM uu UNION ALL
  SELECT (SELECT max(id) FROM uu) + row_number() OVER (ORDER BY user_id NULLS LAST), user_id, {cols}, 1
  FROM ub WHERE NOT EXISTS (SELECT 1 FROM uu WHERE uu.is_active = 1 AND uu.user_id = ub.user_id))"""


def _fact_batch_sql(src: str, k: int, version: int) -> str:
    cat = " AND ".join(f"ca.{c} = s.{c}" for c in gold.CATEGORY_KEYS)
    fea = " AND ".join(f"fe.{c} = s.{c}" for c in gold.FEATURE_KEYS)
    return f"""SELECT s.row_id, u.id AS user_id, ci.id AS city_id, di.id AS district_id,
  CAST(strftime(CAST(s.created_at AS DATE), '%Y%m%d') AS INTEGER) AS date_id,
  ca.id AS category_id, fe.id AS property_feature_id, {', '.join('s.' + m for m in gold.FACT_MEASURES)},
  {version} AS _commit_version
FROM {src} s LEFT JOIN (SELECT * FROM u{k} WHERE is_active = 1) u ON u.user_id = s.user_id
LEFT JOIN ci{k} ci ON ci.city_id = s.city_id LEFT JOIN di{k} di ON di.district_id = s.district_id
LEFT JOIN ca{k} ca ON {cat} LEFT JOIN fe{k} fe ON {fea}"""


GOLD_TWO_RUNS_SQL = f"""WITH s AS ({S}),
sa AS (SELECT * FROM s WHERE year(created_at) - 1995 <= 2), sb AS (SELECT * FROM s WHERE year(created_at) - 1995 > 2),
{_users_sql()},
{_upsert_sql('ci', ['city_id'], 'sa', 'sb')},
{_upsert_sql('di', ['district_id'], 'sa', 'sb')},
{_upsert_sql('ca', gold.CATEGORY_KEYS, 'sa', 'sb')},
{_upsert_sql('fe', gold.FEATURE_KEYS, 'sa', 'sb')}
{_fact_batch_sql('sa', 1, 2)}
UNION ALL
{_fact_batch_sql('sb', 2, 6)}"""


@query("gold_two_runs", GOLD_TWO_RUNS_SQL)
def q_gold_two_runs(spark, sf):
    """Gold increments over versioned silver: run 1 sees versions up to 2,
    run 2 the rest (dimensions extended and history closed, fact keyed
    against the dimensions as they stand after each run), run 3 is skipped."""
    root = scratch_path(spark, "gold")
    slv = silver.clean_listings(raw_listings(spark, sf))
    io.append_version(slv.withColumn(io.VERSION, F.year("created_at") - 1995), f"{root}/silver")
    src = f"{root}/silver"
    ran = [gold.run_gold(spark, src, root, until=2), gold.run_gold(spark, src, root), gold.run_gold(spark, src, root)]
    if ran != [True, True, False]:
        raise RuntimeError(f"unexpected gate decisions {ran}")
    return io.read_versions(spark, f"{root}/fact_posts")


def _history_sql(lo: int, hi: int) -> str:
    rows = f"(SELECT * FROM {RAW_LISTINGS_SQL} r1 WHERE year(create_time) - 1995 > {lo} AND year(create_time) - 1995 <= {hi})"
    seen = f"(SELECT * FROM {RAW_LISTINGS_SQL} r2 WHERE year(create_time) - 1995 <= {hi})"
    return f"SELECT *, {hi} AS _commit_version FROM ({silver.clean_listings_sql(rows, history_sql=seen)}) b{hi}"


@query("silver_three_runs", "\nUNION ALL\n".join(_history_sql(*r) for r in ((-1, 1), (1, 3), (3, 6))))
def q_silver_three_runs(spark, sf):
    """Silver loaded in three runs: each imputes its rows from all bronze
    versions up to its own, kept as additive value counts."""
    root = scratch_path(spark, "history")
    raw = raw_listings(spark, sf)
    io.append_version(raw.withColumn(io.VERSION, F.year("createdAt") - 1995), f"{root}/bronze")
    for until in (1, 3, 6):
        silver.run_silver(spark, f"{root}/bronze", root, until=until)
    return io.read_versions(spark, f"{root}/silver")


@query("incremental_crash_retry", f"""SELECT o_orderkey, o_totalprice,
  CAST(CASE WHEN year(o_orderdate) - 1995 <= 2 THEN 2 ELSE 6 END AS INTEGER) AS _commit_version FROM orders""")
def q_incremental_crash_retry(spark, sf):
    """A run that fails after its data is written, while the source moves on:
    the next run finishes the recorded range, then takes the newer versions,
    and every source row is there once."""
    root = scratch_path(spark, "crash")
    src, dst, marks = (os.path.join(root, p) for p in ("src", "dst", "state"))
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_totalprice", (F.year("o_orderdate") - 1995).alias(io.VERSION))
    io.append_version(o.where(F.col(io.VERSION) <= 2), src)

    class Crash(Exception):
        pass

    def write_and_crash(changes, since, upto):
        io.append_version(changes.drop(io.VERSION), dst, version=upto)
        raise Crash

    try:
        incremental_steps(spark, marks, "orders", src, write_and_crash)
    except Crash:
        pass
    io.append_version(o.where(F.col(io.VERSION) > 2), src)
    incremental(spark, marks, "orders", src, dst, lambda changes: changes.drop(io.VERSION))
    return io.read_versions(spark, dst)


# A listing feed with unusable ids: every 24th id is text that is no number.
BAD_IDS_SQL = f"(SELECT * REPLACE (CASE WHEN category = 7 THEN 'x' || id ELSE id END AS id) FROM {RAW_LISTINGS_SQL} b)"


@query("silver_bad_ids", f"""SELECT row_id, count(*) AS n, max(price) AS price FROM ({silver.clean_listings_sql(BAD_IDS_SQL)}) s GROUP BY row_id""")
def q_silver_bad_ids(spark, sf):
    """De-duplication keeps every row whose id is unusable."""
    raw = raw_listings(spark, sf)
    raw = raw.withColumn("id", F.when(F.col("category") == 7, F.concat(F.lit("x"), "id")).otherwise(F.col("id")))
    slv = silver.clean_listings(raw, dedup=True)
    return slv.groupBy("row_id").agg(F.count(F.lit(1)).alias("n"), F.max("price").alias("price"))


NAN_AREA_SQL = f"""(SELECT * REPLACE (CASE WHEN advertiser_type = '1-URGENT' THEN 'NaN' ELSE CAST(area AS VARCHAR) END AS area)
FROM {RAW_LISTINGS_SQL} b)"""


@query("silver_nan_area", silver.clean_listings_sql(NAN_AREA_SQL))
def q_silver_nan_area(spark, sf):
    """An area that reads "NaN" is missing: filled by the group's median."""
    raw = raw_listings(spark, sf)
    area = F.when(F.col("advertiser_type") == "1-URGENT", "NaN").otherwise(F.col("area").cast("string"))
    return silver.clean_listings(raw.withColumn("area", area))

"""Change feeds with changed and deleted rows. Three states of ``orders``, by
rules on its columns: in the first some rows are missing, cheaper or without a
status, in the second others are, the third is a subset of the table itself."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeshelf.operators import dims as dm
from lakeshelf.plans.registry import query
from lakeshelf.session import materialize, read_table, scratch_path
from lakeshelf.sources import changes as ch
from lakeshelf.sources import io

KEYS = ["o_orderkey"]
_COLS = "o_orderkey, o_custkey, CASE WHEN o_orderkey % {a} = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus, " \
        "CASE WHEN o_orderkey % {b} = 0 THEN o_totalprice / 2 ELSE o_totalprice END AS o_totalprice"
#: (rows without a status, rows at half the price, rows that are missing), by divisors of the key
RULES = [(11, 3, 5), (13, 2, 4), (1_000_000_007, 1_000_000_007, 7)]


def _state_sql(k: int) -> str:
    a, b, c = RULES[k]
    return f"(SELECT {_COLS.format(a=a, b=b)} FROM orders WHERE o_orderkey % {c} <> 0)"


def _state(spark, sf, k):
    a, b, c = RULES[k]
    o = read_table(spark, sf, "orders")
    return o.where(F.col("o_orderkey") % c != 0).selectExpr(*[x.strip() for x in _COLS.format(a=a, b=b).split(", ")])


def _changes_sql(i: int, j: int) -> str:
    same = " AND ".join(f"o.{c} IS NOT DISTINCT FROM n.{c}" for c in ("o_custkey", "o_orderstatus", "o_totalprice"))
    return f"""SELECT 'insert' AS _change_type, n.* FROM {_state_sql(j)} n WHERE NOT EXISTS (SELECT 1 FROM {_state_sql(i)} o WHERE o.o_orderkey = n.o_orderkey)
UNION ALL SELECT 'delete', o.* FROM {_state_sql(i)} o WHERE NOT EXISTS (SELECT 1 FROM {_state_sql(j)} n WHERE o.o_orderkey = n.o_orderkey)
UNION ALL SELECT 'update_preimage', o.* FROM {_state_sql(i)} o JOIN {_state_sql(j)} n USING (o_orderkey) WHERE NOT ({same})
UNION ALL SELECT 'update_postimage', n.* FROM {_state_sql(i)} o JOIN {_state_sql(j)} n USING (o_orderkey) WHERE NOT ({same})"""


def _feed(spark, sf):
    """The feed of both changes, stored as versions 1 and 2."""
    path = scratch_path(spark, "feed")
    for v in (1, 2):
        io.append_version(ch.row_changes(_state(spark, sf, v - 1), _state(spark, sf, v), KEYS), path, version=v)
    return io.read_versions(spark, path)


@query("changes_row_level", _changes_sql(0, 1))
def q_changes_row_level(spark, sf):
    """Inserted, changed (both images) and deleted rows between two states."""
    return ch.row_changes(_state(spark, sf, 0), _state(spark, sf, 1), KEYS)


@query("changes_net", _changes_sql(0, 2))
def q_changes_net(spark, sf):
    """Two versions of the feed as one change for each key."""
    return ch.net(io.read_changes(_feed(spark, sf), since=0), KEYS)


@query("changes_applied", _state_sql(2)[1:-1])
def q_changes_applied(spark, sf):
    """A table that follows the feed, one version at a time; the second is
    applied twice, as after a crash."""
    feed, t = _feed(spark, sf), _state(spark, sf, 0)
    for v in (1, 2, 2):
        t = materialize(ch.apply(t, ch.net(io.read_changes(feed, since=v - 1, until=v), KEYS), KEYS), "followed")
    return t


@query("changes_signed_totals", f"""SELECT o_custkey, count(*) AS orders, round(sum(o_totalprice), 2) AS total
FROM {_state_sql(2)} s GROUP BY o_custkey""")
def q_changes_signed_totals(spark, sf):
    """Totals for each customer kept by signed changes: the first state's, then
    what the feed adds and takes, without reading the second or third state."""
    first = _state(spark, sf, 0).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("t"))
    delta = ch.signed(ch.net(io.read_changes(_feed(spark, sf), since=0), KEYS))
    delta = delta.groupBy("o_custkey").agg(F.sum("__sign").alias("n"), F.sum(F.col("__sign") * F.col("o_totalprice")).alias("t"))
    both = first.unionByName(delta).groupBy("o_custkey").agg(F.sum("n").alias("orders"), F.round(F.sum("t"), 2).alias("total"))
    return both.where(F.col("orders") > 0)


DIM = "id bigint, o_orderkey bigint, o_orderstatus string, is_active int"


@query("changes_to_history", f"""
WITH a AS {_state_sql(0)}, b AS {_state_sql(1)},
d1 AS (SELECT CAST(row_number() OVER (ORDER BY o_orderkey) AS BIGINT) AS id, o_orderkey, o_orderstatus FROM a),
changed AS (SELECT d1.o_orderkey FROM d1 JOIN b USING (o_orderkey) WHERE d1.o_orderstatus IS DISTINCT FROM b.o_orderstatus),
fresh AS (SELECT b.o_orderkey, b.o_orderstatus FROM b WHERE o_orderkey IN (SELECT o_orderkey FROM changed) OR o_orderkey NOT IN (SELECT o_orderkey FROM d1))
SELECT id, o_orderkey, o_orderstatus, CASE WHEN o_orderkey IN (SELECT o_orderkey FROM changed) THEN 0 ELSE 1 END AS is_active FROM d1
UNION ALL SELECT (SELECT max(id) FROM d1) + row_number() OVER (ORDER BY o_orderkey), o_orderkey, o_orderstatus, 1 FROM fresh""")
def q_changes_to_history(spark, sf):
    """A type-2 dimension fed with new images: each update closes and opens one
    row; changes of other columns and deletions leave the history as it is."""
    path = scratch_path(spark, "dim_orders")
    feed = io.read_changes(_feed(spark, sf), since=0, until=1)
    for delta in (_state(spark, sf, 0), ch.upserts(ch.net(feed, KEYS))):
        dm.scd2_in_place(path, delta.select("o_orderkey", "o_orderstatus"), "o_orderkey", ["o_orderstatus"], DIM, buckets=8, null_safe=True)
    return dm.read_dim(spark, path, DIM)

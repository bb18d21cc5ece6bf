"""Imputation queries over ``gappy_lineitem`` (lineitem with missing values
made by rules on other columns; group = supplier, itself sometimes NULL)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeshelf.operators import impute as im
from lakeshelf.plans.registry import query
from lakeshelf.plans.roles import GAPPY_LINEITEM_SQL as G
from lakeshelf.plans.roles import gappy_lineitem


def _mode_sql(col: str) -> str:
    return f"""(SELECT grp, {col} AS m_{col} FROM (
  SELECT grp, {col}, row_number() OVER (PARTITION BY grp ORDER BY n DESC, {col}) AS r
  FROM (SELECT grp, {col}, count(*) AS n FROM {G} g WHERE {col} IS NOT NULL GROUP BY grp, {col}) f
) WHERE r = 1)"""


@query("impute_mode", f"""
SELECT x.l_orderkey, x.l_partkey, x.l_suppkey, x.grp,
  coalesce(x.qty, mq.m_qty, 1) AS qty, coalesce(x.line, ml.m_line, 1) AS line, x.price
FROM {G} x LEFT JOIN {_mode_sql('qty')} mq ON x.grp = mq.grp
LEFT JOIN {_mode_sql('line')} ml ON x.grp = ml.grp""")
def q_impute_mode(spark, sf):
    return im.impute_mode(gappy_lineitem(spark, sf), "grp", ["qty", "line"], default=1)


@query("impute_median", f"""
SELECT x.l_orderkey, x.l_partkey, x.l_suppkey, x.grp, x.qty, x.line,
  coalesce(x.price, m.med, 500) AS price
FROM {G} x LEFT JOIN (SELECT grp, quantile_disc(price, 0.5) AS med FROM {G} g GROUP BY grp) m
  ON x.grp = m.grp""")
def q_impute_median(spark, sf):
    return im.impute_median(gappy_lineitem(spark, sf), "grp", "price", default=500)


@query("impute_mode_overwrite", f"""
SELECT x.l_orderkey, x.l_partkey, x.l_suppkey, x.grp,
  coalesce(mq.m_qty, 1) AS qty, x.line, x.price
FROM {G} x LEFT JOIN {_mode_sql('qty')} mq ON x.grp = mq.grp""")
def q_impute_mode_overwrite(spark, sf):
    return im.impute_mode(gappy_lineitem(spark, sf), "grp", ["qty"], default=1, overwrite=True)


@query("impute_all", f"""
SELECT x.l_orderkey, x.l_partkey, x.l_suppkey, x.grp,
  coalesce(x.qty, mq.m_qty, 1) AS qty, coalesce(x.line, ml.m_line, 1) AS line,
  coalesce(x.price, m.med, 500) AS price
FROM {G} x LEFT JOIN {_mode_sql('qty')} mq ON x.grp = mq.grp
LEFT JOIN {_mode_sql('line')} ml ON x.grp = ml.grp
LEFT JOIN (SELECT grp, quantile_disc(price, 0.5) AS med FROM {G} g GROUP BY grp) m ON x.grp = m.grp""")
def q_impute_all(spark, sf):
    """Modes and median in one aggregate pass and one join."""
    return im.impute(gappy_lineitem(spark, sf), "grp", modes={"qty": 1, "line": 1},
                     medians={"price": 500})


@query("mode_by_group", f"""
SELECT grp, {'qty'} AS mode_qty FROM (
  SELECT grp, qty, row_number() OVER (PARTITION BY grp ORDER BY n DESC, qty) AS r
  FROM (SELECT grp, qty, count(*) AS n FROM {G} g WHERE qty IS NOT NULL GROUP BY grp, qty) f
) WHERE r = 1""")
def q_mode_by_group(spark, sf):
    return im.mode_by_group(gappy_lineitem(spark, sf), "grp", "qty")


@query("median_by_group", f"""
SELECT grp, quantile_disc(price, 0.5) AS median_price FROM {G} g GROUP BY grp""")
def q_median_by_group(spark, sf):
    return im.median_by_group(gappy_lineitem(spark, sf), "grp", "price")


@query("median_exact_by_group", f"""
SELECT l_suppkey, quantile_disc(l_extendedprice, 0.5) AS median_l_extendedprice
FROM lineitem GROUP BY l_suppkey""")
def q_median_exact(spark, sf):
    from lakeshelf.session import read_table
    li = read_table(spark, sf, "lineitem").select("l_suppkey", "l_extendedprice")
    return im.median_by_group(li, "l_suppkey", "l_extendedprice", exact=True)


@query("impute_median_large_groups", """
SELECT x.l_orderkey, x.l_linenumber, x.l_returnflag, coalesce(x.price, m.med, 500) AS price
FROM (SELECT *, CASE WHEN l_linenumber = 2 THEN NULL ELSE l_extendedprice END AS price FROM lineitem) x
LEFT JOIN (SELECT l_returnflag, quantile_disc(l_extendedprice, 0.5) AS med FROM lineitem WHERE l_linenumber <> 2
  GROUP BY l_returnflag) m ON x.l_returnflag = m.l_returnflag""")
def q_impute_median_large_groups(spark, sf):
    """Three groups that grow with the data, most prices distinct."""
    from lakeshelf.session import read_table
    price = F.when(F.col("l_linenumber") != 2, F.col("l_extendedprice"))
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", price.alias("price"))
    return im.impute_median(li, "l_returnflag", "price", default=500)

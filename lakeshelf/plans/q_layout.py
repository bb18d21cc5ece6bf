"""Searches over stored layouts (trigram index, clustered files) and silver
writes that keep rejected values."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeshelf.operators import quarantine as qu
from lakeshelf.operators import search as se
from lakeshelf.plans.registry import query
from lakeshelf.plans.roles import LISTINGS_SQL as L
from lakeshelf.plans.roles import RAW_LISTINGS_SQL as RAW
from lakeshelf.plans.roles import listings, raw_listings
from lakeshelf.plans.silver import RAW_FIELDS
from lakeshelf.session import scratch_path
from lakeshelf.sources import clustered, textindex
from lakeshelf.sources.io import VERSION

FILES = 16
SHOW = ", ".join(se.SHOWN)
NAMES = r"er#0+1\d*7$|UST.mer#0+42"


@query("search_indexed", f"SELECT row_id, user_name FROM {L} l WHERE regexp_matches(user_name, '(?i)er#0+1\\d*7$|ust.mer#0+42')")
def q_search_indexed(spark, sf):
    """Listings by their owner's name, through a trigram index of the files."""
    table, index = scratch_path(spark, "by_owner"), scratch_path(spark, "trigrams")
    listings(spark, sf).repartitionByRange(FILES, "user_name").write.parquet(table)
    textindex.build(spark, table, "user_name", index)
    return textindex.search(spark, table, index, "user_name", NAMES).select("row_id", "user_name")


def _clustered(spark, sf):
    path = scratch_path(spark, "clustered")
    clustered.write_clustered(listings(spark, sf), path, ["price", "area", "district_id"], FILES)
    return path


RANGE = se.Criteria(min_price=150000, max_area=3500)
RANGE_SQL = f"(SELECT * FROM {L} l WHERE price >= 150000 AND area <= 3500)"
MIXED = se.Criteria(min_area=1200, max_price=250000, transaction_type="o", furnished=True)
MIXED_SQL = f"""(SELECT * FROM {L} l WHERE area >= 1200 AND price <= 250000 AND lower(transaction_type) = 'o'
  AND has_furnished = 'Yes')"""


def _top(hits):
    return f"SELECT {SHOW}, (SELECT count(*) FROM {hits} c) AS total FROM {hits} h ORDER BY price, row_id LIMIT 5"


@query("search_clustered", _top(RANGE_SQL))
def q_search_clustered(spark, sf):
    """Only ranges: files inside them are counted unread."""
    return clustered.search(spark, _clustered(spark, sf), RANGE)[0]


@query("search_clustered_mixed", _top(MIXED_SQL))
def q_search_clustered_mixed(spark, sf):
    """Ranges and other criteria: one pass over the files that the ranges leave."""
    return clustered.search(spark, _clustered(spark, sf), MIXED)[0]


# duckdb's name of each type that rejects can come from
_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "float": "FLOAT", "double": "DOUBLE", "decimal(10,5)": "DECIMAL(10,5)"}
_TEXT = {s: t for s, (_, t) in RAW_FIELDS.items() if t in _TYPES and s in (
    "id", "user.iam_verified", "location.lat", "location.lng", "age", "ac", "ketchen", "wc", "beds", "livings", "furnished",
    "rent_period", "daily_rentable")}
REJECTS_SQL = "(" + " UNION ALL ".join(
    f"""SELECT id AS key, '{s}' AS "column", '{t}' AS type, "{s}" AS value FROM {RAW} r
WHERE "{s}" IS NOT NULL AND TRY_CAST("{s}" AS {_TYPES[t]}) IS NULL""" for s, t in _TEXT.items()) + ")"


def _quarantined(spark, sf):
    """Both versions of the feed (by creation year) written with their
    rejects, the first one twice, as after a failure."""
    raw = raw_listings(spark, sf)
    table, q = scratch_path(spark, "silver"), scratch_path(spark, "quarantine")
    early = F.year("create_time") < 1996
    counts = [qu.write_with_quarantine(raw.where(cond), RAW_FIELDS, "id", table, q, v)
              for v, cond in ((0, early), (0, early), (1, ~early))]
    return table, q, counts[1:]


@query("silver_quarantine", f"""SELECT q.key, q."column", q.type, q.value, CASE WHEN year(r.create_time) < 1996 THEN 0 ELSE 1 END AS version
FROM {REJECTS_SQL} q JOIN {RAW} r ON q.key = r.id""")
def q_silver_quarantine(spark, sf):
    _, q, _ = _quarantined(spark, sf)
    return qu.read_quarantine(spark, q).withColumnRenamed(VERSION, "version")


_COUNTED = [f"""SELECT '{s}' AS "column", (SELECT count(*) FROM {REJECTS_SQL} q WHERE q."column" = '{s}') AS rejects""" for s in RAW_FIELDS]


@query("quarantine_counts", " UNION ALL ".join(
    _COUNTED + [f"SELECT 'rows', (SELECT count(*) FROM {RAW} r)"]))
def q_quarantine_counts(spark, sf):
    """What the writes observed: rejects by column and the rows written, over both versions."""
    _, _, counts = _quarantined(spark, sf)
    rows = [(c, sum(n[c] for n in counts)) for c in counts[0]]  # a row for each column
    return spark.createDataFrame(rows, "column string, rejects bigint")

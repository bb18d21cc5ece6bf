"""Trigram index, clustered files and quarantine: what they read and keep."""

import re

import pytest
from pyspark.sql import functions as F

from lakeshelf.functions.predicates import matches_ci
from lakeshelf.operators import quarantine as qu
from lakeshelf.operators import search as se
from lakeshelf.plans import q_layout as ql
from lakeshelf.plans.roles import listings
from lakeshelf.sources import clustered, textindex
from lakeshelf.sources.io import VERSION


def opened(df):
    return {f.rsplit("/", 1)[-1] for f in df.inputFiles()}


# ---- trigram index -----------------------------------------------------------

@pytest.mark.parametrize("pattern, want", [
    ("Villa", [["ill", "lla", "vil"]]), ("ab", None), ("abc|de", None), ("abcd?", [["abc"]]), ("abc*", None), ("abc{0,2}xyz", [["xyz"]]),
    (r"a\.bc", [["a.b", ".bc"]]), (r"abc\dxyz", [["abc", "xyz"]]), ("(abc)", None), (r"\Qabc\E", None), ("[a-z]abc", [["abc"]]),
    ("[a[b]]abc", None), ("ab+cde", [["cde"]]), ("élan vital", [["lan", "an ", "n v", " vi", "vit", "ita", "tal"]]), ("", None)])
def test_required_trigrams(pattern, want):
    got = textindex.required(pattern)
    assert got == (None if want is None else [sorted(w) for w in want])


TEXTS = ["", "ab", None, "Straßen-Kelvin K200", "İstanbul ıslak", "ſilver sand", "a.bc", "abbcde", "x" * 20000 + "Needle", "ÉLAN VITAL", "aébc", "tail\nabc"]


def test_index_gives_what_a_scan_gives(spark, tmp_path):
    t, ix = str(tmp_path / "t"), str(tmp_path / "ix")
    rows = [(i, x, "clash") for i, x in enumerate(TEXTS)]
    for r in rows:  # a file for each row
        spark.createDataFrame([r], "id int, text string, file string").coalesce(1).write.mode("append").parquet(t)
    textindex.build(spark, t, "text", ix)
    whole = spark.read.parquet(t)
    for p in ["needle", "kelvin k200", "istanbul", "islak", "silver", r"a\.bc", "ab+cde", "élan", "straßen", "zzz", "ab", "needle|SILVER sand", "abc$"]:
        want = sorted(r["id"] for r in whole.where(matches_ci("text", p)).collect())
        assert sorted(r["id"] for r in textindex.search(spark, t, ix, "text", p).collect()) == want, p
    assert len(opened(textindex.search(spark, t, ix, "text", "needle"))) == 1
    assert len(opened(textindex.search(spark, t, ix, "text", "needle|SILVER sand"))) == 2
    assert len(opened(textindex.search(spark, t, ix, "text", "ab"))) == len(TEXTS)
    assert textindex.search(spark, t, ix, "text", "no such words").count() == 0


def test_index_of_an_empty_table(spark, tmp_path):
    t, ix = str(tmp_path / "t"), str(tmp_path / "ix")
    spark.createDataFrame([], "text string").write.parquet(t)
    textindex.build(spark, t, "text", ix)
    assert textindex.search(spark, t, ix, "text", "abc").count() == 0


# ---- clustered files ---------------------------------------------------------

def test_interleaved_bits(spark):
    r = spark.createDataFrame([(0b101, 0b011)], "a int, b int").select(clustered.interleave([F.col("a"), F.col("b")], 3)).first()
    assert r[0] == 0b100111


def test_rank_counts_cuts(spark):
    cuts = [1.0, 2.0, 2.5, 7.0, 9.0]
    vs = [0.0, 1.0, 1.5, 2.0, 2.6, 8.0, 9.0, 100.0]
    got = spark.createDataFrame([(v,) for v in vs], "v double").select("v", clustered.rank(F.col("v"), cuts).alias("r")).collect()
    assert all(r["r"] == sum(c <= r["v"] for c in cuts) for r in got)


@pytest.fixture(scope="module")
def table(spark, sf, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("clustered") / "t")
    bad = F.when(F.col("row_id") % 11 == 0, F.lit(float("nan"))).when(F.col("row_id") % 13 == 0, None).otherwise(F.col("price"))
    clustered.write_clustered(listings(spark, sf).withColumn("price", bad), path, ["price", "area", "district_id"], 16)
    return path


@pytest.mark.parametrize("c", [
    se.Criteria(), se.Criteria(min_price=1e9), ql.RANGE, ql.MIXED, se.Criteria(max_price=60000), se.Criteria(min_area=900, max_area=1500),
    se.Criteria(city="asia", min_price=30000), se.Criteria(min_bedrooms=4)])
def test_clustered_search_equals_a_scan(spark, table, c):
    got, files = clustered.search(spark, table, c)
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in se.search(spark.read.parquet(table), c).collect()]
    assert len(files) == len(set(files))


def test_files_outside_are_not_opened(spark, table):
    every = len(opened(spark.read.parquet(table)))
    _, files = clustered.search(spark, table, se.Criteria(max_price=30000))
    assert 0 < len(files) < every / 2
    assert clustered.search(spark, table, se.Criteria(min_price=1e9))[1] == []


def test_counted_files_are_opened_by_price(spark, tmp_path):
    path = str(tmp_path / "t")
    li = spark.range(4000).selectExpr("id AS row_id", "CAST((id * 7919) % 4000 AS DOUBLE) AS price", "1 AS bedrooms")
    clustered.write_clustered(li, path, ["price"], 16)
    top, files = clustered.search(spark, path, se.Criteria(), 5, show=["row_id", "price"])
    assert [(r["price"], r["total"]) for r in top.collect()] == [(float(i), 4000) for i in range(5)]
    assert len(files) == 1


# ---- quarantine --------------------------------------------------------------

FIELDS = {"id": ("row_id", "bigint"), "a.b": ("n", "int"), "t": ("t", "string")}
RAW = "id string, `a.b` string, t string"


def test_rejected_cells_are_kept_and_a_retry_replaces_them(spark, tmp_path):
    t, q = str(tmp_path / "t"), str(tmp_path / "q")
    first = spark.createDataFrame([("1", "x", "p"), ("y", "", None), ("3", None, "r"), (None, "9", "")], RAW)
    assert qu.write_with_quarantine(first, FIELDS, "id", t, q, 0) == {"rows": 4, "id": 1, "a.b": 2, "t": 0}
    got = sorted((r["key"], r["column"], r["type"], r["value"], r[VERSION]) for r in qu.read_quarantine(spark, q).collect())
    assert got == [("1", "a.b", "int", "x", 0), ("y", "a.b", "int", "", 0), ("y", "id", "bigint", "y", 0)]
    clean = spark.createDataFrame([("1", "2", "p")], RAW)
    assert qu.write_with_quarantine(clean, FIELDS, "id", t, q, 0) == {"rows": 1, "id": 0, "a.b": 0, "t": 0}
    assert qu.read_quarantine(spark, q).count() == 0
    assert [tuple(r) for r in spark.read.parquet(t).collect()] == [(1, 2, "p", 0)]
    empty = spark.createDataFrame([], RAW)
    assert qu.write_with_quarantine(empty, FIELDS, "id", t, q, 1)["rows"] == 0


def test_the_raw_table_is_scanned_once(spark, tmp_path):
    raw = str(tmp_path / "raw")
    spark.createDataFrame([("1", "x", "p")], RAW).write.parquet(raw)
    from pyspark.sql import Observation
    df = qu.measured(qu.typed_with_rejects(spark.read.parquet(raw), FIELDS, ["id"]), FIELDS, Observation())
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Relation \[", plan)) == 1

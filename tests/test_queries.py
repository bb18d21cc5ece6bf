"""Every registered query runs at sf0.001 and agrees with its SQL oracle."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from lakeshelf.plans import registry
from scripts.check_oracle import TABLES, digest

registry.load_all()
QUERIES = dict(registry.QUERIES)
ORACLES = dict(registry.ORACLES)


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf, f"{t}.parquet")
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    srows = [tuple(r) for r in df.collect()]
    rel = con.execute(ORACLES[name])
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows)[0] == digest(dcols, drows)[0]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0


@pytest.mark.parametrize("name", ["stream_ingest", "stream_enrich", "stream_route", "stream_route_bounded"])
def test_streams_read_a_table_of_several_files(spark, sf, con, tmp_path, name):
    for t in TABLES:
        if t != "events" and os.path.exists(p := os.path.join(sf, f"{t}.parquet")):
            os.symlink(p, tmp_path / f"{t}.parquet")
    parts = str(tmp_path / "events.parquet")
    spark.read.parquet(f"{sf}/events.parquet").repartition(3).write.parquet(parts)
    assert sum(f.endswith(".parquet") for f in os.listdir(parts)) == 3
    df = QUERIES[name](spark, str(tmp_path))
    rel = con.execute(ORACLES[name])
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest([d[0] for d in rel.description], rel.fetchall())[0]

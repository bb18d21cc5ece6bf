"""Plan shape checks: no query pairs rows without an equi-key (no cartesian
or nested-loop joins), filters reach the parquet scan, and the imputation
joins its lookups once."""

import contextlib
import io

import pytest

from lakeshelf.plans import registry

registry.load_all()
QUERIES = dict(registry.QUERIES)


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairwise_joins(spark, sf, name):
    text = plan_text(QUERIES[name](spark, sf))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name,needle", [
    ("scan_layer", "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]"),
    ("search_filter", "GreaterThanOrEqual(o_totalprice,100000.0)"),
    ("changes_since", "PartitionFilters: [isnotnull(_commit_version"),
])
def test_pushdown(spark, sf, name, needle):
    assert needle in plan_text(QUERIES[name](spark, sf))


def test_scan_prunes_columns(spark, sf):
    text = plan_text(QUERIES["scan_layer"](spark, sf))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_totalprice:double>" in text


def test_impute_joins_lookups_once(spark, sf):
    text = plan_text(QUERIES["silver_clean"](spark, sf))
    # feed: orders-customer, customer-nation, nation-region; cleaning: the
    # category code table and ONE lookup table for all ten imputed columns
    assert text.count("BroadcastHashJoin") // 2 == 5  # each join appears in tree and details
    assert text.count("SortMergeJoin") == 0


def test_stream_lookup_reads_touched_buckets_without_a_shuffle(spark, tmp_path):
    from pyspark.sql import functions as F

    from lakeshelf.streaming import alerts as al
    path = f"file://{tmp_path}/lookup"
    li = spark.range(5000).select(F.col("id").alias("row_id"), *[F.lit("x").alias(c) for c in al.LOOKUP_COLUMNS], F.lit(1).alias("updated_at"))
    al.write_lookup(li, path, buckets=64)
    batch = spark.createDataFrame([("m", 17), ("n", 23), ("o", None)], "msg_id string, listing_ref bigint")
    out = al.enrich(batch, al.Lookup(spark, path))
    text = plan_text(out)
    assert len([f for f in out.inputFiles() if "/lookup/run-" in f]) == 2  # of 64 buckets
    assert "Exchange hashpartitioning" not in text and "SortMergeJoin" not in text
    assert out.count() == 2

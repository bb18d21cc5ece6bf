"""Versioned tables, change reads, marks and the gated increment."""

import os

from pyspark.sql import functions as F

import glob

import pytest

from lakeshelf.operators.facts import incremental, incremental_steps
from lakeshelf.plans import gold
from lakeshelf.session import scratch_path
from lakeshelf.sources import io, state


def test_append_is_idempotent_per_version(spark):
    path = scratch_path(spark, "t")
    df = spark.range(10).withColumn(io.VERSION, (F.col("id") % 2).cast("int"))
    io.append_version(df, path)
    io.append_version(df.where(F.col(io.VERSION) == 1), path)
    t = io.read_versions(spark, path)
    assert t.count() == 10
    assert io.read_changes(t, since=0).count() == 5
    assert io.current_version(spark, path).first()[0] == 1


def test_marks_and_gate(spark):
    root = scratch_path(spark, "state")
    state.seed_marks(spark, root, ["posts"], state.BRONZE_SEED)
    assert state.get_mark(spark, root, "posts") == "1970-01-01"
    calls = []
    assert state.run_step(spark, root, "v", 3, lambda since, until: calls.append((since, until)))
    assert not state.run_step(spark, root, "v", 3, lambda since, until: calls.append((since, until)))
    assert state.get_mark(spark, root, "v") == "3" and calls == [(None, 3)]


def test_failed_step_keeps_mark(spark):
    root = scratch_path(spark, "state")
    state.set_mark(spark, root, "v", 1)

    def boom(since, until):
        raise RuntimeError("write failed")
    try:
        state.run_step(spark, root, "v", 2, boom)
    except RuntimeError:
        pass
    assert state.get_mark(spark, root, "v") == "1"


def test_incremental_replay(spark):
    root = scratch_path(spark, "inc")
    src_p, dst_p, st = (os.path.join(root, x) for x in ("src", "dst", "st"))
    io.append_version(spark.range(6).withColumn(io.VERSION, (F.col("id") % 3).cast("int")), src_p)
    ident = lambda d: d.drop(io.VERSION)
    assert incremental(spark, st, "x", src_p, dst_p, ident, until=1)
    assert incremental(spark, st, "x", src_p, dst_p, ident)
    assert not incremental(spark, st, "x", src_p, dst_p, ident)
    assert io.read_versions(spark, dst_p).count() == 6


def test_read_layer_catalog_table(spark, sf):
    df = io.read_layer(spark, sf, "", "orders.parquet")
    df.createOrReplaceTempView("lakeshelf_orders_view")
    assert io.read_layer(spark, "", "", "lakeshelf_orders_view", fmt="table").count() == df.count()


def test_latest_version_from_listing(spark):
    path = scratch_path(spark, "lv")
    assert io.latest_version(spark, path) is None
    io.append_version(spark.range(4).withColumn(io.VERSION, (F.col("id") + 3).cast("int")), path)
    assert io.latest_version(spark, path) == 6


def test_scale_conf_sizes_shuffle(spark):
    from lakeshelf.session import apply_scale_conf
    keep = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        apply_scale_conf(spark, input_bytes=100 * (1 << 40))
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) == 409600
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", keep)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(128 << 20))
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(64 << 20))


def _put(spark, path, lo, hi):
    """ids lo..hi-1 as versions id // 10."""
    io.append_version(spark.range(lo, hi).withColumn(io.VERSION, (F.col("id") / 10).cast("int")), path)


def test_crash_before_the_mark_then_newer_source(spark):
    root = scratch_path(spark, "crash")
    src, dst, st = (os.path.join(root, x) for x in ("src", "dst", "st"))
    _put(spark, src, 0, 20)

    def write_then_fail(changes, since, until):
        io.append_version(changes.drop(io.VERSION), dst, version=until)
        raise RuntimeError("lost before the mark")
    with pytest.raises(RuntimeError):
        incremental_steps(spark, st, "x", src, write_then_fail)
    _put(spark, src, 20, 40)
    assert incremental(spark, st, "x", src, dst, lambda d: d.drop(io.VERSION))
    t = io.read_versions(spark, dst)
    assert sorted(r.id for r in t.collect()) == list(range(40))
    assert sorted(r[0] for r in t.select(io.VERSION).distinct().collect()) == [1, 3]
    assert not incremental(spark, st, "x", src, dst, lambda d: d.drop(io.VERSION))


def test_crash_while_a_mark_is_written(spark, monkeypatch):
    """A mark whose file was never renamed into place does not exist."""
    root = scratch_path(spark, "state")
    state.set_mark(spark, root, "a", 1)
    state.set_mark(spark, root, "b", 5)
    monkeypatch.setattr(state.uuid, "uuid4", lambda: (_ for _ in ()).throw(RuntimeError("down")))
    with pytest.raises(RuntimeError):
        state.set_mark(spark, root, "a", 2)
    assert state.read_marks(spark, root) == {"a": "1", "b": "5"}


def test_seeded_mark_loads_every_version(spark):
    root = scratch_path(spark, "seed")
    src, dst, st = (os.path.join(root, x) for x in ("src", "dst", "st"))
    _put(spark, src, 0, 40)
    state.seed_marks(spark, st, ["x"], state.GOLD_SEED)
    assert incremental(spark, st, "x", src, dst, lambda d: d.drop(io.VERSION))
    assert io.read_versions(spark, dst).count() == 40


def _silver(spark, rows):
    """(row_id, user, name, day, updated day) -> a silver table."""
    df = spark.createDataFrame(rows, "row_id long, user_id long, user_name string, created_at string, updated_at string")
    df = df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("created_at", "updated_at")})
    consts = {"advertiser_type": "N/A", "is_verified": "Yes", "city": "c", "district": "d", "property_type": "p",
              "transaction_type": "t", **{k: "Yes" for k in gold.FEATURE_KEYS}}
    df = df.withColumns({**{k: F.lit(v) for k, v in consts.items()}, "city_id": F.lit(1).cast("long"), "district_id": F.lit(2).cast("long")})
    return df.withColumns({m: F.lit(1.0) for m in gold.FACT_MEASURES})


def test_gold_crash_seed_calendar_and_untouched_buckets(spark, tmp_path, monkeypatch):
    root = f"file://{tmp_path}/gold"
    src = f"{root}/silver"
    a = [(i, i, f"u{i}", "2020-01-01", "2020-01-01") for i in range(40)]
    # an old listing that was edited last decides the user's name, not the newer listing
    a += [(100, 7, "edited last", "2019-12-30", "2020-06-01"), (101, 7, "created last", "2020-01-02", "2020-01-02")]
    io.append_version(_silver(spark, a), src, version=0)
    state.seed_marks(spark, f"{root}/state", ["fact_posts"], state.GOLD_SEED)
    build = gold.build_fact
    monkeypatch.setattr(gold, "build_fact", lambda *x: (_ for _ in ()).throw(RuntimeError("down")))
    with pytest.raises(RuntimeError):
        gold.run_gold(spark, src, root)
    monkeypatch.setattr(gold, "build_fact", build)
    io.append_version(_silver(spark, [(200, 3, "renamed", "2020-03-01", "2020-03-01")]), src, version=1)
    files = lambda: set(glob.glob(f"{tmp_path}/gold/dim_users/*/*/*.parquet"))
    assert gold.run_gold(spark, src, root, until=0) and not gold.run_gold(spark, src, root, until=0)
    before = files()
    assert gold.run_gold(spark, src, root)
    assert len(files() - before) == 1 and before < files()  # only the bucket of user 3 was written again
    fact = io.read_versions(spark, f"{root}/fact_posts")
    assert fact.count() == 43 and fact.select("row_id").distinct().count() == 43
    users = {(r.user_id, r.user_name): r.is_active for r in gold.read_dim(spark, root, "users", 1).collect()}
    assert users[(7, "edited last")] == 1 and users[(3, "u3")] == 0 and users[(3, "renamed")] == 1 and len(users) == 41
    days = sorted(r.date for r in gold.read_dim(spark, root, "dates", 1).collect())
    assert len(days) == len(set(days)) == (days[-1] - days[0]).days + 1 == 63
    for n in ("cities", "districts", "categories", "features"):
        assert gold.read_dim(spark, root, n, 1).count() == 1


def test_few_files_per_version_and_no_conf_change(spark, tmp_path):
    spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    df = spark.range(0, 1000, numPartitions=16).withColumn(io.VERSION, (F.col("id") % 7).cast("int"))
    io.append_version(df, f"file://{tmp_path}/t")
    assert len(glob.glob(f"{tmp_path}/t/*/*.parquet")) == 7
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_newest_date_from_folder_names(spark, tmp_path):
    path = f"file://{tmp_path}/dated"
    assert io.newest_date(spark, path).first()[0] is None
    rows = [(1, 2023, 12, 31), (2, 2024, 2, 9), (3, 2024, 2, 10), (4, 2024, 1, 31)]
    spark.createDataFrame(rows, "id int, year int, month int, day int").write.partitionBy("year", "month", "day").parquet(path)
    assert io.newest_date(spark, path).first()[0] == "20240210"
    padded = f"file://{tmp_path}/padded"
    spark.createDataFrame([(1, "2024", "02", "03")], "id int, year string, month string, day string").write.partitionBy("year", "month", "day").parquet(padded)
    assert io.newest_date(spark, padded).first()[0] == "20240203"


def test_scratch_scope_deletes_its_tables(spark):
    from lakeshelf.session import materialize, path_exists, scratch_scope
    with scratch_scope(spark) as top:
        assert materialize(spark.range(3), "x").count() == 3 and path_exists(spark, top)
    assert not path_exists(spark, top)

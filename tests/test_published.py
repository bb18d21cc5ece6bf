"""Published runs, exclusive control files, claims, committed batches: crashes
at each step, two writers at once, readers during loads."""

import glob
import os
import threading

import pytest
from pyspark.sql import functions as F

from lakeshelf.operators import dims as dm
from lakeshelf.session import materialize, path_exists, scratch_root, scratch_scope
from lakeshelf.sources import commits, runs, state
from lakeshelf.streaming import alerts as al

USERS = "id bigint, user_id bigint, user_name string, is_active int"


def _users(spark, rows):
    return spark.createDataFrame(rows, "user_id long, user_name string")


def _scd(spark, path, rows):
    return dm.scd2_in_place(path, _users(spark, rows), "user_id", ["user_name"], USERS, buckets=8)


def _dim(spark, path):
    return sorted(map(tuple, dm.read_dim(spark, path, USERS).collect()))


def test_exclusive_create(spark, tmp_path):
    path = f"file://{tmp_path}/a/b/c.json"
    won = []
    threads = [threading.Thread(target=lambda i=i: won.append((commits.create_exclusive(spark, path, f"w{i}"), i))) for i in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sum(w for w, _ in won) == 1
    assert commits.read_text(spark, path) == f"w{next(i for w, i in won if w)}"
    assert [n for n, _ in commits.names_in(spark, f"file://{tmp_path}/a/b")] == ["c.json"]


def test_history_survives_a_kill_between_buckets(spark, tmp_path, monkeypatch):
    clean, path = f"file://{tmp_path}/clean", f"file://{tmp_path}/dim"
    first, second = [(i, f"u{i}") for i in range(50)], [(i, f"v{i}") for i in range(0, 60, 2)]
    for p in (clean, path):
        _scd(spark, p, first)
    before = _dim(spark, path)
    # the run is there in part, the state never came
    real = runs.write_run

    def half(df, p, s):
        real(df.where(F.col(runs.BUCKET) < 4), p, s)
        raise RuntimeError("executor and driver lost")

    monkeypatch.setattr(runs, "write_run", half)
    with pytest.raises(RuntimeError):
        _scd(spark, path, second)
    monkeypatch.setattr(runs, "write_run", real)
    assert _dim(spark, path) == before
    # the run is whole, but the writer died before the state
    monkeypatch.setattr(runs, "publish", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("driver lost")))
    with pytest.raises(RuntimeError):
        _scd(spark, path, second)
    monkeypatch.undo()
    assert _dim(spark, path) == before
    for p in (clean, path):
        _scd(spark, p, second)
    assert _dim(spark, path) == _dim(spark, clean) and len(_dim(spark, path)) == 80
    _scd(spark, path, second)  # once more: nothing changes
    assert _dim(spark, path) == _dim(spark, clean)
    runs.retire(spark, path, keep=1)
    assert _dim(spark, path) == _dim(spark, clean)
    left = {f.split("/")[-2] for f in glob.glob(f"{tmp_path}/dim/run-*/_SUCCESS")}
    assert left == set(sum(runs.newest(spark, path).runs.values(), []))


def test_two_writers_of_a_dimension(spark, tmp_path):
    path = f"file://{tmp_path}/dim"
    _scd(spark, path, [(i, f"u{i}") for i in range(20)])
    base = runs.newest(spark, path)
    _scd(spark, path, [(1, "x")])
    bucket = _users(spark, [(1, "y")]).select(F.pmod(F.hash("user_id"), F.lit(8)).alias("b")).first().b
    rows = spark.createDataFrame([(1, 1, "y", 1, bucket)], USERS + ", _bucket int")
    with pytest.raises(runs.Conflict):
        runs.replace(rows, path, base, [bucket])
    assert (21, 1, "x", 1) in _dim(spark, path)


def test_marks_move_once_under_two_writers(spark, tmp_path):
    root = f"file://{tmp_path}/state"
    state.set_mark(spark, root, "t", 1)
    ran, calls, gate = [], [], threading.Event()

    def step(since, until):
        calls.append((since, until))
        gate.wait(20)

    def job():
        ran.append(state.run_step(spark, root, "t", 5, step))
        gate.set()

    threads = [threading.Thread(target=job) for _ in range(4)]
    [t.start() for t in threads]
    [t.join(60) for t in threads]
    assert sorted(ran) == [False, False, False, True] and calls == [(1, 5)] and state.get_mark(spark, root, "t") == "5"
    # a killed holder: its claim counts until it is too old
    state._put(spark, root, "t#started", '{"since": "5", "until": "7", "held": true, "at": %f}' % (state.time.time() - 100))
    assert not state.run_step(spark, root, "t", 9, step)
    assert state.run_step(spark, root, "t", 9, step, claim_seconds=50)
    assert calls == [(1, 5), (5, 7), (7, 9)]
    # numbers only grow: moves by hand never collide
    threads = [threading.Thread(target=state.set_mark, args=(spark, root, "n", i)) for i in range(6)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(glob.glob(f"{tmp_path}/state/n~*.mark")) == 6


def test_scopes_belong_to_their_thread(spark):
    inside, leave, seen = threading.Event(), threading.Event(), []

    def batch():
        with scratch_scope(spark) as top:
            materialize(spark.range(2), "theirs")
            seen.append(top)
            inside.set()
            leave.wait(30)

    t = threading.Thread(target=batch)
    t.start()
    inside.wait(30)
    mine = materialize(spark.range(5), "mine")
    leave.set()
    t.join()
    assert not path_exists(spark, seen[0]) and mine.count() == 5


def _feed(spark, path, lo, hi):
    spark.range(lo, hi).select(F.col("id").cast("string").alias("id"), F.col("id").cast("string").alias("listing_ref"), F.lit("c").alias("comment"),
                               F.lit("p").alias("phone_number"), F.lit(0).cast("long").alias("_ts")).coalesce(1).write.mode("append").parquet(path)


def _run(spark, feed, make, out, ckpt):
    s = al.project_interactions(al.read_interactions(spark, feed, max_files=1))
    al.run_available(al.write_batches(s, make, out, ckpt, {"availableNow": True}))


def test_two_streams_and_a_main_thread_query(spark, tmp_path):
    feed = f"file://{tmp_path}/feed"
    for k in range(4):
        _feed(spark, feed, 10 * k, 10 * k + 10)

    def make(batch):
        a = materialize(batch, "a")
        return materialize(a.join(batch.select("msg_id"), "msg_id"), "b")

    queries = []
    for n in ("x", "y"):
        s = al.project_interactions(al.read_interactions(spark, feed, max_files=1))
        queries.append(al.write_batches(s, make, f"file://{tmp_path}/{n}", f"file://{tmp_path}/{n}_ckpt", {"availableNow": True}))
    held = [materialize(spark.range(k + 1), "main") for k in range(6)]
    for q in queries:
        al.run_available(q)
    assert [h.count() for h in held] == [1, 2, 3, 4, 5, 6]
    assert [al.read_batches(spark, f"file://{tmp_path}/{n}").count() for n in ("x", "y")] == [40, 40]


def test_new_checkpoint_keeps_old_batches(spark, tmp_path):
    feed, out = f"file://{tmp_path}/feed", f"file://{tmp_path}/out"
    schema = "msg_id string, listing_ref bigint, phone_number string, comment string, event_time timestamp_ntz"
    assert al.read_batches(spark, out, schema).count() == 0
    _feed(spark, feed, 0, 5)
    _run(spark, feed, lambda b: b, out, f"file://{tmp_path}/c1")
    _run(spark, feed, lambda b: b.limit(0), out, f"file://{tmp_path}/c2")
    assert al.read_batches(spark, out).count() == 5 and len(al.committed_batches(spark, out)) == 2


def test_crash_between_write_and_commit(spark, tmp_path, monkeypatch):
    feed, out, ckpt = (f"file://{tmp_path}/{n}" for n in ("feed", "out", "ckpt"))
    _feed(spark, feed, 0, 5)
    real = commits.create_exclusive
    monkeypatch.setattr(commits, "create_exclusive", lambda s, p, t: (_ for _ in ()).throw(RuntimeError("down")) if "_commits" in p else real(s, p, t))
    with pytest.raises(Exception):
        _run(spark, feed, lambda b: b, out, ckpt)
    assert al.committed_batches(spark, out) == [] and len(glob.glob(f"{tmp_path}/out/*~*/*.parquet")) >= 1
    monkeypatch.undo()
    _feed(spark, feed, 5, 8)
    _run(spark, feed, lambda b: b, out, ckpt)
    assert sorted(int(r.msg_id) for r in al.read_batches(spark, out).collect()) == list(range(8))


def _listings(spark, rows):
    return spark.createDataFrame([(i, who, "d", "c", "p", 1.0, 2.0, at) for i, who, at in rows],
                                 "row_id long, user_name string, district string, city string, property_type string, area double, price double, updated_at int")


def test_lookup_loads_compacts_and_keeps_reader_files(spark, tmp_path):
    path = f"file://{tmp_path}/lookup"
    look = al.Lookup(spark, path)
    ev = spark.createDataFrame([(str(i), i) for i in range(40)], "msg_id string, listing_ref long")
    who = lambda df: {r.msg_id: r.user_name for r in df.collect()}
    with pytest.raises(FileNotFoundError):
        al.enrich(ev, look)
    al.write_lookup(_listings(spark, [(i, "old", 1) for i in range(40)]), path)
    size = sum(os.path.getsize(f) for f in glob.glob(f"{tmp_path}/lookup/run-*/*/*.parquet"))
    with runs.reading():
        before = al.enrich(ev, look)
        for k in range(3):
            al.write_lookup(_listings(spark, [(k, f"new{k}", 5)]), path)
        al.write_lookup(_listings(spark, [(0, "late but older", 0)]), path)
        # a load costs its own size, whatever is stored
        assert sum(os.path.getsize(f) for f in glob.glob(f"{tmp_path}/lookup/run-*/*/*.parquet")) < 2 * size
        assert al.compact_lookup(spark, path, runs_at_least=2, keep=1)
        assert set(who(before).values()) == {"old"}  # its files are still there
    after = who(al.enrich(ev, look))
    assert [after[str(k)] for k in range(4)] == ["new0", "new1", "new2", "old"] and len(after) == 40
    assert all(len(r) == 1 for r in runs.newest(spark, path).runs.values())
    al.compact_lookup(spark, path, runs_at_least=1, keep=1)  # all buckets, and nobody reads the first run any more
    assert len(glob.glob(f"{tmp_path}/lookup/run-*")) == len(glob.glob(f"{tmp_path}/lookup/_states/*.json")) == 1
    assert who(al.enrich(ev, look)) == after


def test_load_during_a_compaction_stays_on_top(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/lookup"
    for who, at in (("a", 1), ("b", 2)):
        al.write_lookup(_listings(spark, [(1, who, at)]), path)
    real = runs.write_run

    def load_first(df, p, s):
        out = real(df, p, s)
        monkeypatch.setattr(runs, "write_run", real)
        al.write_lookup(_listings(spark, [(1, "c", 3)]), path)
        return out

    monkeypatch.setattr(runs, "write_run", load_first)
    al.compact_lookup(spark, path, runs_at_least=2)
    ev = spark.createDataFrame([("m", 1)], "msg_id string, listing_ref long")
    assert al.enrich(ev, al.Lookup(spark, path)).first().user_name == "c"
    assert sorted(map(len, runs.newest(spark, path).runs.values())) == [2]


def test_a_load_leaves_nothing_in_the_scratch_folder(spark, tmp_path):
    top = scratch_root(spark).removeprefix("file://")
    rows = materialize(_listings(spark, [(1, "a", 1)]), "rows")
    files = lambda: set(glob.glob(f"{top}/lakeshelf/**/*.parquet", recursive=True))
    before = files()
    for _ in range(2):
        al.write_lookup(rows, f"file://{tmp_path}/lookup")
    assert before and files() == before

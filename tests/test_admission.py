"""The row-limited stream source: limits, start position, restarts."""

import os

import pytest

from lakeshelf.streaming import admission as adm
from lakeshelf.streaming import alerts as al

SCHEMA = "k long, t string, absent double"


def land(spark, folder, name, lo, hi, parts=1):
    spark.range(lo, hi, numPartitions=parts).selectExpr("id AS k", "'x' || id AS t").write.mode("append").parquet(f"{folder}/{name}")


def run(spark, tmp, rows, start="earliest", stop_after=None):
    """(k values, rows of each batch) of a run over what is there."""
    from pyspark.sql.types import StructType
    s = adm.read_admitted(spark, f"{tmp}/in", StructType.fromDDL(SCHEMA), f"{tmp}/progress", rows, start)
    sizes = []

    def keep(batch):
        sizes.append(batch.count())
        return batch

    q = al.write_batches(s, keep, f"{tmp}/out", f"{tmp}/ckpt", {"processingTime": "0 seconds"})
    try:
        if stop_after is None:
            q.processAllAvailable()
        else:
            while q.isActive and len(al.committed_batches(spark, f"{tmp}/out")) < stop_after:
                q.awaitTermination(0.05)
    finally:
        q.stop()
    return sorted(r.k for r in al.read_batches(spark, f"{tmp}/out", SCHEMA).collect()), sizes


def test_no_batch_is_above_the_limit_and_a_restart_goes_on(spark, tmp_path):
    tmp = str(tmp_path)
    land(spark, f"{tmp}/in", "a", 0, 250, 2)
    _, first = run(spark, tmp, 60, stop_after=2)
    land(spark, f"{tmp}/in", "b", 250, 333)
    keys, sizes = run(spark, tmp, 60)
    assert keys == list(range(333))
    assert max(first + sizes) == 60
    assert run(spark, tmp, 60)[0] == list(range(333))


def test_start_latest_skips_what_is_there(spark, tmp_path):
    tmp = str(tmp_path)
    land(spark, f"{tmp}/in", "old", 0, 40)
    assert run(spark, tmp, 25, "latest") == ([], [0])
    land(spark, f"{tmp}/in", "new", 100, 160)
    keys, sizes = run(spark, tmp, 25, "latest")
    assert keys == list(range(100, 160)) and max(sizes) == 25


def test_empty_folder_then_rows(spark, tmp_path):
    tmp = str(tmp_path)
    os.makedirs(f"{tmp}/in")
    assert run(spark, tmp, 10, "latest")[0] == []
    land(spark, f"{tmp}/in", "new", 0, 15)
    assert run(spark, tmp, 10, "latest")[0] == list(range(15))


def test_offsets_are_the_same_after_a_crash_before_the_batch(tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq
    from pyspark.sql.types import StructType
    os.makedirs(tmp_path / "in")
    pq.write_table(pa.table({"k": list(range(30))}), tmp_path / "in" / "a.parquet", row_group_size=7)
    options = {"path": str(tmp_path / "in"), "progress": str(tmp_path / "p"), "rows": "12", "start": "earliest"}
    schema = StructType.fromDDL("k long")
    one = adm.AdmissionReader(options, schema)
    end = one.latestOffset()
    assert end == {"file": 0, "row": 12} == adm.AdmissionReader(options, schema).latestOffset()  # not planned yet
    got = [x for p in one.partitions(one.initialOffset(), end) for b in one.read(p) for x in b.column("k").to_pylist()]
    assert got == list(range(12))
    again = adm.AdmissionReader(options, schema)
    assert again.latestOffset() == {"file": 0, "row": 24}
    again.partitions(end, {"file": 0, "row": 24})
    assert adm.AdmissionReader(options, schema).latestOffset() == {"file": 1, "row": 0}


@pytest.mark.parametrize("option", [{"rows": 0}, {"start": "now"}])
def test_bad_options(tmp_path, option):
    with pytest.raises(ValueError):
        adm.AdmissionReader({"path": "x", "progress": "y", "rows": 1, "start": "latest", **option}, None)


def test_a_worker_decodes_each_row_once_over_successive_batches(tmp_path, monkeypatch):
    """Any ranges give their rows; batches that go on from each other do not
    decode a row group again, and a file that was replaced is opened anew."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    from pyspark.sql.types import StructType
    decoded = []

    class Counting(pq.ParquetFile):
        def iter_batches(self, *a, **k):
            for b in super().iter_batches(*a, **k):
                decoded.append(b.num_rows)
                yield b

    monkeypatch.setattr(pq, "ParquetFile", Counting)
    path = str(tmp_path / "in.parquet")
    pq.write_table(pa.table({"k": list(range(50_000))}), path, row_group_size=20_000)
    options = {"path": path, "progress": str(tmp_path / "p"), "rows": "700", "start": "earliest"}
    reader = adm.AdmissionReader(options, StructType.fromDDL("k long, absent string"))

    def rows(first, last):
        return [x for b in reader.read(adm.Range(path, first, last)) for x in b.column("k").to_pylist()]

    for first in range(0, 50_000, 700):
        assert rows(first, min(first + 700, 50_000)) == list(range(first, min(first + 700, 50_000)))
    assert sum(decoded) == 50_000
    for first, last in [(10, 20), (5, 8), (19_990, 40_010), (40_010, 40_011), (8_190, 8_195), (30_000, 50_000), (7, 7), (49_999, 50_000)]:
        assert rows(first, last) == list(range(first, last))
    rows(0, 700)
    pq.write_table(pa.table({"k": list(range(90_000, 95_000))}), path)
    assert rows(700, 1_400) == list(range(90_700, 91_400))


def test_a_batch_does_not_list_the_batches_before(spark, tmp_path, monkeypatch):
    """Each batch asks for its own commit alone, reads the batch once where
    told so, and the folder of each row's batch is known."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import StructType
    tmp = str(tmp_path)
    land(spark, f"{tmp}/in", "a", 0, 100)
    listed, kept = [], []
    names, materialize = al.commits.names_in, al.materialize
    monkeypatch.setattr(al.commits, "names_in", lambda *a: listed.append(a) or names(*a))
    monkeypatch.setattr(al, "materialize", lambda *a: kept.append(a) or materialize(*a))
    s = adm.read_admitted(spark, f"{tmp}/in", StructType.fromDDL(SCHEMA), f"{tmp}/progress", 30)
    q = al.write_batches(s, lambda b: b, f"{tmp}/out", f"{tmp}/ckpt", {"processingTime": "0 seconds"}, once=True)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert not listed and not kept
    done = al.committed_batches(spark, f"{tmp}/out")
    got = al.read_batches(spark, f"{tmp}/out").groupBy(F.expr(al.BATCH).alias("b")).count().collect()
    assert sorted((r.b, r["count"]) for r in got if r["count"]) == list(zip(done, [30, 30, 30, 10]))


def run_lanes(spark, tmp, rows, lanes, start="earliest", stop_after=None):
    """(k values, rows of each batch, streams) of a run of all lanes over what is there."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import StructType
    streams = adm.read_lanes(spark, f"{tmp}/in", StructType.fromDDL(SCHEMA), f"{tmp}/progress", rows, start, lanes)
    qs = [al.write_batches(s, lambda b: b, f"{tmp}/out", f"{tmp}/ckpt/{k}", {"processingTime": "0 seconds"}, once=True)
          for k, s in enumerate(streams)]
    try:
        if stop_after is None:
            for q in qs:
                q.processAllAvailable()
        else:
            while all(q.isActive for q in qs) and len(al.committed_batches(spark, f"{tmp}/out")) < stop_after:
                qs[0].awaitTermination(0.05)
    finally:
        for q in qs:
            q.stop()
    got = al.read_batches(spark, f"{tmp}/out", SCHEMA).select("k", F.expr(al.BATCH).alias("b")).collect()
    sizes = {}
    for r in got:
        sizes[r.b] = sizes.get(r.b, 0) + 1
    return sorted(r.k for r in got), sizes, len(qs)


def test_lanes_read_every_row_once_within_the_limit_and_go_on(spark, tmp_path):
    """Streams side by side are stopped and started again; files come between."""
    tmp = str(tmp_path)
    land(spark, f"{tmp}/in", "a", 0, 203, 2)
    land(spark, f"{tmp}/in", "one", 203, 204)  # shares of most lanes are empty
    run_lanes(spark, tmp, 20, 3, stop_after=2)
    land(spark, f"{tmp}/in", "b", 204, 290)
    keys, sizes, n = run_lanes(spark, tmp, 20, 5)  # the first start fixed the number
    assert n == 3 and len({b.split("~")[0] for b in sizes}) == 3
    assert keys == list(range(290)) and max(sizes.values()) == 20
    assert run_lanes(spark, tmp, 20, 3)[0] == list(range(290))


def test_lanes_skip_the_same_files(spark, tmp_path, monkeypatch):
    """What is there counts from the first call on, not from each lane's start."""
    from pyspark.sql.types import StructType
    tmp = str(tmp_path)
    land(spark, f"{tmp}/in", "old", 0, 40)
    names, source = [], type(spark.dataSource)
    monkeypatch.setattr(source, "register", lambda self, s, real=source.register: names.append(s.name()) or real(self, s))
    adm.read_lanes(spark, f"{tmp}/in", StructType.fromDDL(SCHEMA), f"{tmp}/progress", 25, "latest", 2)
    assert len(set(names)) == 2  # streams that start together must not share a source's environment
    land(spark, f"{tmp}/in", "new", 100, 160)
    keys, sizes, _ = run_lanes(spark, tmp, 25, 2, "latest")
    assert keys == list(range(100, 160)) and max(sizes.values()) == 25


@pytest.mark.parametrize("lanes", [1, 2, 7])
def test_shares_of_a_file_cover_it(tmp_path, lanes):
    import pyarrow as pa
    import pyarrow.parquet as pq
    from pyspark.sql.types import StructType
    os.makedirs(tmp_path / "in")
    for i, n in enumerate([0, 3, 100]):
        pq.write_table(pa.table({"k": [1000 * i + x for x in range(n)]}), tmp_path / "in" / f"{i}.parquet", row_group_size=9)
    got = []
    for lane in range(lanes):
        reader = adm.AdmissionReader({"path": str(tmp_path / "in"), "progress": str(tmp_path / f"p{lane}"), "rows": "4", "start": "earliest",
                                      "lane": str(lane), "lanes": str(lanes)}, StructType.fromDDL("k long"))
        at = reader.initialOffset()
        while (end := reader.latestOffset()) != at:
            rows = [x for p in reader.partitions(at, end) for b in reader.read(p) for x in b.column("k").to_pylist()]
            assert len(rows) <= 4
            got, at = got + rows, end
    assert sorted(got) == [1000, 1001, 1002, *range(2000, 2100)]


def test_a_worker_keeps_a_place_for_each_lane(tmp_path, monkeypatch):
    """Lanes take turns in a worker and still decode no row group twice."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    from pyspark.sql.types import StructType
    opened = []
    monkeypatch.setattr(adm, "Place", lambda *a, real=adm.Place: opened.append(1) or real(*a))
    path = str(tmp_path / "in.parquet")
    pq.write_table(pa.table({"k": list(range(9_000))}), path)
    reader = adm.AdmissionReader({"path": path, "progress": str(tmp_path / "p"), "rows": "10", "start": "earliest"}, StructType.fromDDL("k long"))
    for first in range(0, 3_000, 500):
        for lane in range(3):
            a = 3_000 * lane + first
            assert [x for b in reader.read(adm.Range(path, a, a + 500, lane)) for x in b.column("k").to_pylist()] == list(range(a, a + 500))
    assert len(opened) == 3


def test_a_large_backlog_is_shared_by_streams(spark, tmp_path, monkeypatch):
    """The query's result with several streams: every event once, each batch within the limit."""
    from lakeshelf.plans import q_stream
    monkeypatch.setattr(q_stream, "ADMITTED_ROWS", 20)
    monkeypatch.setattr(q_stream, "LANE_BATCHES", 4)
    seen = []
    monkeypatch.setattr(q_stream.adm, "read_lanes", lambda *a, real=adm.read_lanes, **k: seen.append(real(*a, **k)) or seen[-1])
    (spark.range(0, 200, numPartitions=1)
     .selectExpr("id AS event_id", "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id) AS ts", "id % 7 AS user_id",
                 "if(id % 5 = 0, NULL, 'click') AS event_type", "double(id) AS value", "'{}' AS props")
     .write.parquet(str(tmp_path / "events.parquet")))
    rows = q_stream.q_stream_admission(spark, str(tmp_path)).collect()
    assert [len(s) for s in seen] == [2, 2]  # started twice
    assert sorted(int(r.msg_id) for r in rows) == list(range(200))
    assert all(r.admitted for r in rows)


def test_a_query_leaves_the_session_settings_alone(spark, tmp_path):
    tmp = str(tmp_path)
    land(spark, f"{tmp}/in", "a", 0, 10)
    key = "spark.sql.streaming.checkpointFileManagerClass"
    assert key in al._checkpoint_files(spark, tmp)
    assert run(spark, tmp, 5)[0] == list(range(10))
    assert spark.conf.get(key, None) is None

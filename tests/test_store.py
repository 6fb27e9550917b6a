"""The store of clean calls and its loop: touched folders only, replay after a failure, counters and pointers."""

import os

import pytest
from pyspark.errors import StreamingQueryException

from relaylens import catalog
from relaylens.operators import correct
from relaylens.schema import RAW
from relaylens.sources import store as S
from relaylens.sources import tables
from relaylens.streaming.loop import correction_loop
from test_correct import client, producer, record


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def folders(changed):
    return {"/".join(f.split("/")[-3:-1]) for f in changed}


def calls_of(frame):
    return {r.xRequestId: (r.client and r.client["_id"], r.producer and r.producer["_id"], r.correctorStatus, r.matchingType, r.correctorTime) for r in frame.collect()}


def rows(spark, *records):
    return spark.createDataFrame(list(records), RAW)


def test_a_late_batch_rewrites_the_folders_of_its_orphans_alone(spark, tmp_path):
    store = S.CleanStore(spark, str(tmp_path), 8)
    store.apply(rows(spark, *[client(f"c{i}", str(i)) for i in range(40)], *[producer(f"p{i}", str(i)) for i in range(0, 40, 2)]), 0, 10.0)
    store.apply(rows(spark, *[client(f"c{i}", str(i)) for i in range(40, 60)]), 1, 20.0)
    before = files(tmp_path / "calls")
    store.apply(rows(spark, producer("late", "7"), client("again", "8")), 2, 30.0)
    after = files(tmp_path / "calls")
    gone, came = before.keys() - after.keys(), after.keys() - before.keys()
    assert len(folders(gone)) == 1 and folders(gone) == folders(came) and all(after[f] == before[f] for f in before.keys() & after.keys())
    got = calls_of(store.read())
    assert len(got) == 60 and got["7"] == ("c7", "late", "done", "regular_pair", 30.0) and got["9"] == ("c9", None, "processing", "orphan", 10.0)
    assert got["8"] == ("c8", "p8", "done", "regular_pair", 10.0)
    assert [(r["_id"], r.kind, r.batch) for r in store.rejected().collect()] == [("again", "duplicate", 2)]
    one = {r.batch: (r.processed, r.duplicates, r.made, r.completed) for r in store.counters().collect()}
    assert one == {0: (60, 0, 40, 0), 1: (20, 0, 20, 0), 2: (2, 1, 0, 1)}


def test_faulty_invalid_and_duplicates_are_counted_in_the_pass_that_writes(spark, tmp_path):
    store = S.CleanStore(spark, str(tmp_path), 4)
    store.apply(rows(spark, client("c", "1"), client("d", "1"), client("f", None), producer("g", ""), record("x", "1", "Proxy", 1), record("y", None, None, 1)), 0, 1.0)
    r = store.counters().collect()[0]
    assert (r.processed, r.duplicates, r.faulty, r.invalid, r.made, r.completed) == (6, 1, 2, 2, 1, 0)
    assert sorted((r["xRequestId"], r.correctorStatus) for r in store.read().collect()) == [("", "done"), ("", "done"), ("1", "processing")]
    store.apply(rows(spark), 1, 2.0)
    assert store.read().count() == 3 and store.counters().where("batch = 1").collect()[0].processed == 0


def test_the_timeout_closes_calls_and_a_later_partner_keeps_the_time(spark, tmp_path):
    store, day = S.CleanStore(spark, str(tmp_path), 4), 86_400.0
    store.apply(rows(spark, client("c", "1"), record("n", "2", "Client", int(9.9 * day * 1000))), 0, 5.0)
    store.expire(0, 10 * day)
    assert calls_of(store.read()) == {"1": ("c", None, "done", "orphan", 10 * day), "2": ("n", None, "processing", "orphan", 5.0)}
    store.apply(rows(spark, producer("p", "1")), 1, 11 * day)
    assert calls_of(store.read())["1"] == ("c", "p", "done", "regular_pair", 10 * day)


def test_a_batch_without_some_columns_and_with_others(spark, tmp_path):
    store = S.CleanStore(spark, str(tmp_path), 2)
    store.apply(rows(spark, client("c", "1")), 0, 1.0)
    store.apply(rows(spark, producer("p", "1")).drop("faultCode", "insertTime").selectExpr("'x' as part", "'y' as batch", "*"), 1, 2.0)
    assert calls_of(store.read()) == {"1": ("c", "p", "done", "regular_pair", 2.0)}


LANDED = [
    [client(f"c{i}", str(i)) for i in range(12)],
    [producer(f"p{i}", str(i)) for i in range(0, 12, 2)] + [client("dup", "3"), client("lost", None)],
    [producer(f"p{i}", str(i)) for i in range(1, 12, 2)] + [producer("only", "99"), record("z", "1", "Proxy", 1)],
]


def land(spark, path, upto):
    for i, records in enumerate(LANDED[:upto]):
        where = f"{path}/{i}"
        if not os.path.exists(where):
            rows(spark, *records).coalesce(1).write.json(where)


def run(spark, path, checkpoint, store):
    stream = spark.readStream.schema(RAW).option("maxFilesPerTrigger", 1).json(f"{path}/*")
    correction_loop(store, stream, str(checkpoint), now=lambda: 50.0, days=None, pointer=["securityServerType"]).awaitTermination()


@pytest.mark.parametrize("where", ["before the stage", "while putting in place", "before it is noted"])
def test_a_batch_that_fails_midway_is_repeated(spark, tmp_path, monkeypatch, where):
    store = S.CleanStore(spark, str(tmp_path / "store"), 4)
    land(spark, tmp_path / "in", 1)
    run(spark, tmp_path / "in", tmp_path / "checkpoint", store)
    land(spark, tmp_path / "in", 3)
    method, name = (S.CleanStore._save, "_save") if where == "before the stage" else (S.CleanStore._publish, "_publish")

    def fail(self, *args):
        if where == "before it is noted":
            method(self, *args)
        if where == "while putting in place":  # as if the committer had removed an old folder and then died
            staged = self._placed(args[0]).select("part", "batch").distinct().collect()
            for r in staged[:1]:
                p = spark._jvm.org.apache.hadoop.fs.Path(self._at("calls") + f"/part={r.part}/batch={r.batch}")
                p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
        raise RuntimeError("killed")

    monkeypatch.setattr(S.CleanStore, name, fail)
    with pytest.raises(StreamingQueryException):
        run(spark, tmp_path / "in", tmp_path / "checkpoint", store)
    monkeypatch.undo()
    run(spark, tmp_path / "in", tmp_path / "checkpoint", store)
    want = correct.correct_batch(rows(spark, *[r for b in LANDED for r in b]), 50.0)["clean"]
    plain = lambda df: sorted((r.xRequestId, r.client and r.client["_id"] or "", r.producer and r.producer["_id"] or "", r.correctorStatus, r.matchingType) for r in df.collect())
    assert plain(store.read()) == plain(want)
    counted = store.counters().selectExpr("sum(processed) p", "sum(duplicates) d", "sum(faulty) f", "sum(invalid) i", "sum(made) m", "sum(completed) c").collect()[0]
    assert tuple(counted) == (28, 1, 1, 1, 13, 12)
    ends = {r.securityServerType: r.position for r in tables.current(store.pointers(), ["securityServerType"]).collect()}
    assert ends["Producer"] == 1020.0 and ends["Client"] == 1000.0
    run(spark, tmp_path / "in", tmp_path / "checkpoint", store)
    assert store.counters().count() == 3


def shuffled(spark):
    """Rows that stages have written for others so far."""
    gateway = spark.sparkContext._gateway
    stages = spark._jsc.sc().statusStore().stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList())
    return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))


def test_a_batch_moves_whole_records_once_and_whole_pairs_never(spark, tmp_path):
    store = S.CleanStore(spark, str(tmp_path), 4)
    before = shuffled(spark)
    store.apply(rows(spark, *[client(f"c{i}", str(i)) for i in range(300)], *[producer(f"p{i}", str(i)) for i in range(299)]), 0, 1.0)
    assert shuffled(spark) - before < 100
    before = shuffled(spark)
    store.apply(rows(spark, producer("late", "299")), 1, 2.0)
    assert shuffled(spark) - before < 100
    got = calls_of(store.read())
    assert len(got) == 300 and got["299"] == ("c299", "late", "done", "regular_pair", 2.0) and got["0"] == ("c0", "p0", "done", "regular_pair", 1.0)


@pytest.mark.parametrize("name", ["t1_correction_loop", "s14_upsert", "j2_late_partner"])
def test_a_query_shuffles_fewer_rows_than_it_reads_records(spark, name):
    path, before = "/root/testdata/sf0.001", shuffled(spark)
    catalog.QUERIES[name](spark, path).collect()
    records = sum(spark.read.parquet(f"{path}/{t}.parquet").count() for t in ("orders", "lineitem"))
    assert shuffled(spark) - before < records


def test_a_batch_leaves_pairs_as_they_lie_and_empties_folders_without_orphans(spark, tmp_path, monkeypatch):
    store = S.CleanStore(spark, str(tmp_path), 1)
    store.apply(rows(spark, client("c1", "1"), producer("p1", "1"), client("c2", "2")), 0, 1.0)
    pairs = {f: t for f, t in files(tmp_path).items() if "/staged" not in f and {"part=0", "batch=0"} <= set(f.split("/")) and spark.read.parquet(f).where("matchingType = 'regular_pair'").count()}
    assert pairs
    emptied = S.CleanStore._emptied
    monkeypatch.setattr(S.CleanStore, "_emptied", lambda self, *args: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):  # after what is staged was written, before its counters
        store.apply(rows(spark, producer("p2", "2"), producer("again", "1")), 1, 2.0)
    monkeypatch.setattr(S.CleanStore, "_emptied", emptied)
    store.apply(rows(spark, producer("p2", "2"), producer("again", "1")), 1, 2.0)
    assert pairs.items() <= files(tmp_path).items() and not files(tmp_path / "calls")
    assert sorted(store.read().select("xRequestId", "client._id", "producer._id", "correctorTime").toDF("x", "c", "p", "t").collect()) == [("1", "c1", "p1", 1.0), ("2", "c2", "p2", 2.0)]
    assert [(r.processed, r.duplicates, r.made, r.completed) for r in store.counters().orderBy("batch").collect()] == [(3, 0, 2, 0), (2, 1, 0, 1)]

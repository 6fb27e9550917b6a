"""Nulls, ties, repeats and empty tables for reports, stores, pointers, archives and incidents."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from relaylens.functions import expr as X
from relaylens.operators import anomaly, network, query, report
from relaylens.schema import CLIENT_ID, SERVICE_CALL, SERVICE_ID
from relaylens.sources import tables
from test_anomaly_and_stream import HOUR, calls


def test_member_triples_with_nulls_and_repeats(spark):
    names = [*CLIENT_ID, *SERVICE_ID[:4]]
    rows = [("x", "g", "1", None, "x", None, "2", "s"), ("x", "g", "1", "", "x", "g", None, "s"), ("x", "g", "1", None, "x", None, "2", "s"), (None,) * 8]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in names))
    got = [tuple(r) for r in report.member_triples(df).collect()]
    assert sorted(got, key=str) == sorted([("1", "", "g"), ("2", "s", None)], key=str)
    assert report.member_triples(df.where("false")).count() == 0


def test_calls_of_either_side_at_the_bounds(spark):
    side = "struct<requestInTs:long>"
    df = spark.createDataFrame([(((c,) if c is not None else None), ((p,) if p is not None else None)) for c, p in [(10, None), (9, 20), (None, 21), (None, None), (9, 21), (None, 10)]], f"client {side}, producer {side}")
    assert report.clean_calls_between(df, 10, 20).count() == 3


@pytest.mark.parametrize("least, most, archived", [(1, 2, [1, 2]), (4, 9, [1, 2, 3, 4]), (5, 9, []), (1, 0, [])])
def test_archive_batches_with_ties(spark, least, most, archived):
    df = spark.createDataFrame([(3, 5), (1, 5), (2, 5), (4, 6), (5, 100), (6, None)], "id long, t long")
    batch, rest = tables.archive_batch(df, F.col("t") < 50, least, most, ["t", "id"])
    assert sorted(r.id for r in batch.collect()) == archived
    assert sorted(r.id for r in rest.collect()) == [i for i in range(1, 7) if i not in archived]


@pytest.mark.parametrize("most", [1, 2, 3, 5, 6, 7, 8, 9, 10])
def test_archive_batches_by_bucket(spark, most):
    """Buckets of several rows with ties; the cut at a bucket's first, middle and last row, or beyond all."""
    rows = [(1, 5), (2, 5), (3, 9), (4, 21), (5, 21), (6, 21), (7, 38), (8, 30), (9, 60), (10, None)]
    df = spark.createDataFrame(rows, "id long, t long").repartition(3)
    batch, rest = tables.archive_batch(df, F.col("t") < 50, 1, most, ["t", "id"], F.floor(F.col("t") / 10))
    order = [i for _, i in sorted((t, i) for i, t in rows if t is not None and t < 50)][:most]
    assert sorted(r.id for r in batch.collect()) == sorted(order)
    assert sorted(r.id for r in rest.collect()) == [i for i in range(1, 11) if i not in order]


def test_archive_batches_of_nothing(spark):
    df = spark.createDataFrame([], "id long, t long")
    batch, rest = tables.archive_batch(df, F.col("t") < 50, 1, 5, ["t", "id"])
    assert batch.count() == rest.count() == 0


def test_pointers_move_and_roll_back(spark):
    log = spark.createDataFrame([], "k string, position double, batch int")
    log = tables.moved(log, spark.createDataFrame([("a", 5), (None, 7)], "k string, position long"), ["k"], 1)
    log = tables.moved(log, spark.createDataFrame([("a", 9)], "k string, position long"), ["k"], 2)
    at = lambda until=None: {r.k: r.position for r in tables.current(log, ["k"], until).collect()}
    assert at() == {"a": 9.0, None: 7.0} and at(1) == {"a": 5.0, None: 7.0} and at(0) == {}
    wanted = spark.createDataFrame([("a",), ("new",)], "k string")
    assert {r.k: r.position for r in tables.pointer(tables.current(log, ["k"]), ["k"], wanted, 1.0).collect()} == {"a": 9.0, "new": 1.0}


def test_models_by_version_and_value(spark):
    df = spark.createDataFrame([("m", 1, "x"), ("m", 3, "y"), ("m", 3, None), ("n", 9, "z")], "model_name string, version int, v string")
    assert sorted(str(r.v) for r in tables.of_version(df, "m").collect()) == ["None", "y"]
    assert [r.v for r in tables.of_version(df, "m", 1).collect()] == ["x"] and tables.of_version(df, "gone").count() == 0
    assert sorted(str(r.v) for r in tables.without_values(df, "v", ["y", "z"]).collect()) == ["None", "x"]
    assert tables.without_values(df, "v", []).count() == 4


def test_one_model_row_a_period(spark):
    model = anomaly.PeriodModel(metrics=["request_count"])
    frame = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10), 2), (dt.datetime(2024, 1, 2, 10), 3)], "period timestamp, request_count long").withColumns({c: F.lit("x") for c in SERVICE_CALL})
    fit = model.fit(frame)
    again = fit.unionByName(fit).unionByName(fit.withColumns({"version": F.lit(2), "request_count_mean": F.lit(0.0)}))
    assert sorted((r.version, r.request_count_mean) for r in model.one_a_period(again).collect()) == [(1, 2.0), (1, 3.0)]
    assert model.one_a_period(fit.where("false")).count() == 0


def test_retraining_keeps_the_version_and_drops_old_periods(spark):
    model = anomaly.PeriodModel(metrics=["request_count"])
    frame = lambda day, x, code: spark.createDataFrame([(dt.datetime(2024, 1, day, 10), x)], "period timestamp, request_count long").withColumns({c: F.lit("x") for c in SERVICE_CALL}).withColumn("serviceCode", F.lit(code))
    fit = model.fit(frame(1, 2, "a").unionByName(frame(1, 5, "b"))).withColumn("version", F.lit(4))
    again = frame(2, 9, "a").select(*SERVICE_CALL)
    got = sorted((r.serviceCode, r.similar_periods, r.request_count_mean, r.version) for r in model.retrain(fit, frame(2, 9, "a"), again).collect())
    assert got == [("a", "10_1", 9.0, 4), ("b", "10_0", 5.0, 4)]
    none = model.retrain(fit.where("false"), frame(2, 9, "a"), again).collect()
    assert [(r.serviceCode, r.version) for r in none] == [("a", 1)]


def test_incident_counts_and_ids_on_nothing(spark):
    found = anomaly.failed_ratio(calls(spark, [(str(i), i, i > 2, "m", 1) for i in range(4)]), 0.1).withColumn("incident_status", F.lit("incident"))
    assert anomaly.incident_requests(found).collect()[0].request_count == 4
    assert anomaly.incident_requests(found.where("false")).collect()[0].request_count == 0
    assert sorted(r["_id"] for r in anomaly.confirmed_ids(found).collect()) == ["0", "1", "2"]
    assert anomaly.confirmed_ids(found, "new").count() == 0
    assert query.distinct_values(found.where("false"), "serviceCode").count() == 0


def test_training_calls_of_stages_leave_out_waiting_and_incidents(spark):
    df = calls(spark, [(str(i), i * HOUR, i % 5 > 0, "m", 1) for i in range(20)]).withColumn("serviceCode", F.concat(F.lit("s"), (F.col("requestInTs") / HOUR % 4).cast("int").cast("string")))
    stages = spark.createDataFrame([("s0", "regular"), ("s1", "first_train"), ("s2", "waiting")], "code string, stage string").select(*[F.lit(None).cast("string").alias(c) if c == "clientSubsystemCode" else F.col("code").alias(c) if c == "serviceCode" else F.lit("x").alias(c) for c in SERVICE_CALL], "stage")
    incidents = spark.createDataFrame([(["1", "4"], "incident"), (["9"], "new")], "request_ids array<string>, incident_status string")
    got = {(r["_id"], r.stage) for r in anomaly.staged_training_calls(df, stages, incidents, 6 * HOUR, 18 * HOUR).collect()}
    assert got == {("8", "regular"), ("12", "regular"), ("16", "regular"), ("9", "first_train"), ("13", "first_train"), ("17", "first_train")}


def test_windows_within_the_buffer_wait(spark):
    frame = spark.createDataFrame([(dt.datetime(2024, 1, 10, h),) for h in (11, 12, 13)], "period timestamp")
    assert [r.period.hour for r in anomaly.analysable(frame, dt.datetime(2024, 1, 11, 13, 30), 60, 1440).collect()] == [11, 12]


def test_cells_and_texts(spark):
    df = spark.createDataFrame([("<a> & b", None, True), (None, 5, None)], "t string, n long, b boolean")
    assert [r.t for r in query.escaped_cells(df).collect()] == ["&lt;a&gt; &amp; b", None]
    texts = spark.createDataFrame([("a",), (None,), ("z",)], "k string").select(X.translation(F.col("k"), {"a": "A"}).alias("v"), X.translation(F.col("k"), {}).alias("w"))
    assert [tuple(r) for r in texts.collect()] == [("A", "???"), ("???", "???"), ("???", "???")]


def test_upserts_with_ties_and_nulls(spark):
    state = spark.createDataFrame([("a", 1, "old"), ("b", None, "old"), (None, 5, "old"), ("c", 9, "old")], "k string, t long, v string")
    new = spark.createDataFrame([("a", 1, "new"), ("b", 2, "new"), (None, 4, "new"), ("d", None, "new")], "k string, t long, v string")
    assert {r.k: r.v for r in tables.upserted(state, new, ["k"], "t").collect()} == {"a": "new", "b": "new", None: "old", "c": "old", "d": "new"}


def test_ranks_with_ties_nulls_and_no_rows(spark):
    rows = [("a", 1, 5), ("a", 2, 5), ("a", 3, 4), ("a", 4, 4), ("a", 5, 1), (None, 6, 2), (None, 7, None), ("b", 8, None), ("b", 9, None)]
    df = spark.createDataFrame(rows, "k string, v int, n int")
    got = lambda most: sorted((r.v, r["rank"]) for r in network.top_ties(df, ["k"], "n", most).collect())
    assert got(0) == []
    assert got(1) == [(1, 1), (2, 1), (6, 1), (8, 1), (9, 1)]
    assert got(2) == [(1, 1), (2, 1), (6, 1), (7, 2), (8, 1), (9, 1)]
    assert got(3) == [(1, 1), (2, 1), (3, 3), (4, 3), (6, 1), (7, 2), (8, 1), (9, 1)]
    assert network.top_ties(df.where("false"), ["k"], "n", 3).count() == 0


def test_a_day_of_a_request_prunes_folders(spark, tmp_path):
    """Calls without a time have a folder of their own, which no day finds."""
    day = 86_400_000
    df = spark.createDataFrame([(1, 10, 5), (2, day - 1, 6), (3, day, 7), (4, None, 8), (5, 20, None)], "id long, requestInTs long, totalDuration long")
    tables.write_logs(df, str(tmp_path / "log"))
    spec = query.QuerySpec(["id"], [query.Constraint("requestInDate", "=", "1970-01-01"), query.Constraint("totalDuration", ">=", 5)])
    out = query.run_query(tables.read_logs(spark, str(tmp_path / "log")), spec)
    assert sorted(r.id for r in out.collect()) == [1, 2]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(requestInDate" in plan and "GreaterThanOrEqual(totalDuration,5)" in plan
    none = query.QuerySpec(["id"], [query.Constraint("requestInDate", "=", query.NULL_TEXT)])
    assert [r.id for r in query.run_query(tables.read_logs(spark, str(tmp_path / "log")), none).collect()] == [4]

"""Correction scenarios on own records: pairing, duplicates, late partners, timeouts, odd types."""

import pytest

from relaylens.operators import correct
from relaylens.schema import RAW

NAMES = [f.name for f in RAW]


def record(spark_id, xid, kind, ts, **more):
    base = dict.fromkeys(NAMES)
    base |= {"_id": spark_id, "xRequestId": xid, "securityServerType": kind, "requestInTs": ts, "insertTime": 0.0, "messageId": f"m{xid}"}
    return tuple((base | more)[n] for n in NAMES)


def client(i, xid, **more):
    return record(i, xid, "Client", 1000, requestOutTs=1010, responseInTs=1090, responseOutTs=1100, **more)


def producer(i, xid, **more):
    return record(i, xid, "Producer", 1020, requestOutTs=1030, responseInTs=1070, responseOutTs=1080, **more)


def batch(spark, rows, now=10.0, clean=None):
    return correct.correct_batch(spark.createDataFrame(rows, RAW), now, clean)


def one(out):
    rows = out["clean"].collect()
    assert len(rows) == 1
    return rows[0]


def test_pair_has_all_durations(spark):
    r = one(batch(spark, [producer("p", "1"), client("c", "1")]))
    assert (r.correctorStatus, r.matchingType) == ("done", "regular_pair")
    got = [r[k] for k in ("totalDuration", "clientSsRequestDuration", "clientSsResponseDuration", "producerDurationClientView", "producerDurationProducerView", "producerSsRequestDuration", "producerSsResponseDuration", "producerIsDuration", "requestNwDuration", "responseNwDuration")]
    assert got == [100, 10, 10, 80, 60, 10, 10, 40, 10, 10]


def test_orphans_stay_open(spark):
    r = one(batch(spark, [client("c", "1")]))
    assert (r.correctorStatus, r.matchingType, r.producer) == ("processing", "orphan", None)
    r = one(batch(spark, [producer("p", "1")]))
    assert (r.correctorStatus, r.client) == ("processing", None)


def test_faulty_record_is_done_at_once(spark):
    r = one(batch(spark, [client("c", None)]))
    assert (r.correctorStatus, r.matchingType, r.xRequestId) == ("done", "orphan", "")


def test_duplicates_and_case(spark):
    later = record("c2", "1", "cLIeNt", 5000)
    out = batch(spark, [client("c", "1"), later, record("p", "1", "pRODUceR", 1020)])
    assert out["duplicates"].select("_id").collect() == [("c2",)]
    assert one(out).matchingType == "regular_pair"


def test_records_of_neither_side_are_invalid(spark):
    out = batch(spark, [record("x", "1", "Proxy", 1), record("y", "1", None, 1)])
    assert out["clean"].count() == 0 and out["invalid"].count() == 2


def test_partner_in_a_later_batch(spark):
    first = batch(spark, [client("c", "1")])["clean"]
    out = batch(spark, [producer("p", "1"), client("c9", "1")], now=20.0, clean=first)
    r = one(out)
    assert (r.matchingType, r.correctorStatus, r.correctorTime) == ("regular_pair", "done", 20.0)
    assert [d["_id"] for d in out["duplicates"].collect()] == ["c9"]


def test_partner_after_the_timeout_keeps_the_time(spark):
    now = 10 * 86_400.0
    expired = correct.expire(batch(spark, [client("c", "1")])["clean"], now)
    assert (one({"clean": expired}).correctorStatus, one({"clean": expired}).correctorTime) == ("done", now)
    r = one(batch(spark, [producer("p", "1")], now=now + 5, clean=expired))
    assert (r.matchingType, r.correctorStatus, r.correctorTime) == ("regular_pair", "done", now)


@pytest.mark.parametrize("own, other, want", [("/a/15", "/a/*", "/a/*"), ("/a/15", None, "/*"), (None, "/b", None)])
def test_rest_paths(spark, own, other, want):
    rows = [client("c", "1", restPath=own, xRoadVersion="7.6.2")] + ([producer("p", "1", restPath=other, xRoadVersion="7.6.2")] if other else [])
    assert one(batch(spark, rows)).client.restPath == want


@pytest.mark.parametrize("count, want", [(0, 5), (None, 5), (2, 9), (-1, None)])
def test_transaction_size(spark, count, want):
    r = one(batch(spark, [client("c", "1", requestSize=5, requestMimeSize=9, requestAttachmentCount=count)]))
    assert r.clientRequestSize == want


def test_clamp_and_escape(spark):
    r = one(batch(spark, [record("c", "1", "Client", 0, responseOutTs=2**40, faultString="a<b & c>")]))
    assert r.totalDuration == 2**31 - 1
    assert r.client.faultString == "a&lt;b &amp; c&gt;"


def test_legacy_sizes(spark):
    r = one(batch(spark, [client("c", "1", requestSoapSize=0, requestRestSize=7), ]))
    assert (r.clientRequestSize, r.client.serviceType) == (7, "REST")


def test_interval_match_bounds(spark):
    a = spark.createDataFrame([("a", "m", 1_000_000)], "_id string, messageId string, requestInTs long")
    b = spark.createDataFrame([("x", "m", 1_600_000), ("y", "m", 1_600_001), ("z", "other", 1_000_000), ("w", "m", 400_000)], a.schema)
    got = sorted(r.match__id for r in correct.interval_match(a, b, ["messageId"]).collect())
    assert got == ["w", "x"]
    assert correct.first_match(a, b, ["messageId"], ["_id"]).collect()[0].match__id == "w"


def test_null_attributes_match_null(spark):
    a = spark.createDataFrame([("a", None, 0)], "_id string, messageId string, requestInTs long")
    b = spark.createDataFrame([("b", None, 10)], a.schema)
    assert correct.interval_match(a, b, ["messageId"]).count() == 1


def test_interval_match_repeats_rows_of_the_left_side_alone(spark):
    a = spark.range(3).selectExpr("'c' || id as _id", "'m' as messageId", "id * 600000 as requestInTs")
    b = spark.createDataFrame([("p", "m", 1_200_000), ("q", "m", -600_001)], "_id string, messageId string, requestInTs long")
    got = correct.interval_match(a, b, ["messageId"])
    assert sorted((r["_id"], r.match__id) for r in got.collect()) == [("c1", "p"), ("c2", "p")]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate") == 1 and plan.index("Generate") < plan.index("Range") < plan.index("LogicalRDD")

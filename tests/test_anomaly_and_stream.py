import datetime as dt

import pytest
from pyspark.sql import functions as F

from relaylens.operators import anomaly, network, stats
from relaylens.schema import SERVICE_CALL
from relaylens.sources import tables
from relaylens.streaming import pairing

HOUR = 3_600_000


def calls(spark, rows):
    """rows: _id, ts, succeeded, messageId, size."""
    df = spark.createDataFrame(rows, "_id string, requestInTs long, succeeded boolean, messageId string, requestSize long")
    return df.withColumns({**{c: F.lit("x") for c in SERVICE_CALL}, "clientSubsystemCode": F.lit(None).cast("string"), **{c: F.col("requestSize") for c in ("responseSize", "totalDuration", "producerDurationProducerView", "requestNwDuration")}})


@pytest.mark.parametrize("failed, total, found", [(10, 11, 1), (9, 10, 0)])
def test_failed_ratio_is_strict(spark, failed, total, found):
    df = calls(spark, [(str(i), i, i >= failed, "m", 1) for i in range(total)])
    out = anomaly.failed_ratio(df, 0.9).collect()
    assert len(out) == found
    if found:
        assert out[0].clientSubsystemCode == "-" and len(out[0].request_ids) == failed


def test_fit_update_and_refit_agree(spark):
    model = anomaly.PeriodModel(metrics=["request_count"])
    frame = lambda xs: spark.createDataFrame([(dt.datetime(2024, 1, 4 + 7 * i, 10), x) for i, x in xs], "period timestamp, request_count long").withColumns({c: F.lit("x") for c in SERVICE_CALL})
    fit = model.fit(frame([(0, 2), (1, 3)]))
    r = fit.collect()[0]
    assert (r.similar_periods, r.request_count_mean, r.request_count_std, r.request_count_sum, r.request_count_ssq) == ("10_3", 2.5, 0.5, 5.0, 13.0)
    u = model.update(fit, frame([(2, 4)])).collect()[0]
    assert (u.request_count_count, u.request_count_mean, u.version) == (3, 3.0, 2)
    assert u.request_count_std == pytest.approx((2 / 3) ** 0.5)


def test_unseen_period_is_anomalous_only_for_counts(spark):
    model = anomaly.PeriodModel()
    df = calls(spark, [("1", 10 * HOUR, True, "m", 5)])
    frame = anomaly.historic_averages(df)
    empty = model.fit(frame.where("false"))
    assert model.anomalies(frame, empty, "request_count").count() == 1
    assert model.anomalies(frame, empty, "mean_request_size").count() == 0


def test_duplicates_and_time_sync(spark):
    df = calls(spark, [("1", 0, True, "m", -3000), ("2", 1, True, "m", -1000), ("3", 2, True, "n", 0)])
    assert [(r.messageId, r.difference_from_normal) for r in anomaly.duplicate_ids(df).collect()] == [("m", 1.0)]
    assert [(r.monitored_metric_value, r.difference_from_normal, r.request_ids) for r in anomaly.time_sync(df).collect()] == [(-3000.0, 3000.0, ["1"])]


def test_windows_are_half_open():
    w = stats.calendar_windows(dt.datetime(2024, 3, 1))
    assert w["previous_month"][1] == w["current_month"][0] == int(dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc).timestamp() * 1000)
    assert w["previous_year"][1] == w["current_year"][0]


def test_largest_keeps_ties(spark):
    e = spark.createDataFrame([("a", "b", 3), ("a", "c", 2), ("b", "c", 2), ("c", "c", 1)], "clientMemberCode string, serviceMemberCode string, n long")
    assert network.largest(e, ["clientMemberCode", "serviceMemberCode"], 2).count() == 3


def test_servers_from_xml(spark):
    xml = """<conf><member id="o1"><memberClass><code>GOV</code></memberClass><memberCode>1</memberCode><name>N</name></member>
    <securityServer><owner>o1</owner><serverCode>s1</serverCode><address>h</address></securityServer>
    <securityServer><owner>zz</owner><serverCode>s2</serverCode><address>h</address></securityServer>
    <globalSettings><memberClass><code>GOV</code><description>d</description></memberClass></globalSettings></conf>"""
    assert [(r.serverCode, r.member_code) for r in tables.servers(spark, xml).collect()] == [("s1", "1")]
    assert [r.member_class for r in tables.member_classes(spark, xml).collect()] == ["GOV"]


def test_logs_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(0, "a"), (86_400_000, "b")], "requestInTs long, k string")
    tables.write_logs(df, str(tmp_path / "logs"))
    back = tables.read_logs(spark, str(tmp_path / "logs"))
    assert back.where("requestInDate = date'1970-01-02'").collect()[0].k == "b"
    tables.export_ndjson(back, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 2


ARRIVED = "_id string, xRequestId string, securityServerType string, requestInTs long, arrived timestamp"


def arriving(spark, day, *rows):
    return spark.createDataFrame([(*r, dt.datetime(2024, 1, 1) + dt.timedelta(days=day)) for r in rows], ARRIVED).coalesce(1)


def paired(spark, *steps):
    return {r.xRequestId: (r.client_id, r.producer_id, r.status, r.matching, r.expired) for r in pairing.run_pairing(spark, list(steps)).collect()}


def test_stream_pairs_over_batches(spark):
    first = arriving(spark, 0, ("c1", "1", "Client", 0), ("c2", "1", "client", 5), ("c3", "2", "Client", None), ("c4", "2", "Client", 1), ("x", "3", "Proxy", 0), ("y", None, "Client", 0), ("z", "", "Client", 0))
    got = paired(spark, first, arriving(spark, 0, ("p1", "1", "PRODUCER", 10), ("c9", "2", "client", 0)))
    assert got == {"1": ("c1", "p1", "done", "regular_pair", False), "2": ("c3", None, "processing", "orphan", False)}


def test_timeout_then_late_partner_then_forgotten(spark):
    clock = lambda day: arriving(spark, day, (f"k{day}", f"k{day}", "Client", 0))
    steps = [arriving(spark, 0, ("c", "1", "Client", 0), ("d", "2", "Client", 0)), clock(2)]
    assert paired(spark, *steps)["1"] == ("c", None, "processing", "orphan", False)
    steps.append(clock(4))
    assert paired(spark, *steps)["1"] == ("c", None, "done", "orphan", True)
    late = arriving(spark, 20, ("p", "1", "Producer", 7))
    assert paired(spark, *steps, late)["1"] == ("c", "p", "done", "regular_pair", True)
    after = paired(spark, *steps, late, clock(60), arriving(spark, 61, ("n", "2", "Producer", 9)))
    assert after["1"] == ("c", "p", "done", "regular_pair", True)
    assert after["2"] in (("d", None, "done", "orphan", True), (None, "n", "processing", "orphan", False))  # forgotten: its partner begins anew


def test_requests_of_a_bucket_share_their_state_and_time_out_alone(spark, monkeypatch):
    whole = pairing.pair_stream
    monkeypatch.setattr(pairing, "pair_stream", lambda records: whole(records, buckets=1))
    steps = [arriving(spark, 0, ("c", "1", "Client", 0), ("d", "2", "Client", 0), ("q", "2", "Producer", None)), arriving(spark, 2, ("e", "3", "Client", 0)), arriving(spark, 4, ("f", "4", "Client", 0))]
    got = paired(spark, *steps, arriving(spark, 4, ("p", "1", "Producer", 7), ("r", "4", "Producer", 7)))
    assert got == {"1": ("c", "p", "done", "regular_pair", True), "2": ("d", "q", "done", "regular_pair", False), "3": ("e", None, "processing", "orphan", False), "4": ("f", "r", "done", "regular_pair", False)}


def test_incident_requests_of_statuses_that_occur(spark):
    found = spark.createDataFrame([("new", 3), ("new", 4)], "incident_status string, request_count long")
    assert [tuple(r) for r in anomaly.incident_requests(found, "incident_status").collect()] == [("new", 7)]
    assert [tuple(r) for r in anomaly.incident_requests(found.where("false")).collect()] == [(0,)]


def test_historic_averages_with_the_ids_of_their_calls(spark):
    df = calls(spark, [("2", 10, True, "m", 0), ("1", 20, False, "n", 0), ("3", HOUR, True, "m", 0)])
    assert sorted((r.request_count, r.request_ids) for r in anomaly.historic_averages(df, ids=True).collect()) == [(1, ["3"]), (2, ["1", "2"])]

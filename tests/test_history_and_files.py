"""Partials, quarantine, schema log, snapshots, calendar, harvesting and detectors on odd input."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from relaylens.functions import calendar
from relaylens.operators import anomaly, correct, network, partials, query, report, stats
from relaylens.schema import RAW, SERVICE_CALL
from relaylens.sources import tables
from relaylens.sources.store import CleanStore
from relaylens.streaming.loop import correction_loop
from test_anomaly_and_stream import HOUR, calls

DAY = 86_400_000
EDGES = "clientMemberCode string, clientSubsystemCode string, serviceMemberCode string, serviceSubsystemCode string, serviceCode string, requestInTs long"


def same(a, b):
    return sorted(map(str, a.select(sorted(a.columns)).collect())) == sorted(map(str, b.select(sorted(a.columns)).collect()))


def test_edges_from_partials_with_nulls_repeats_and_late_days(spark, tmp_path):
    rows = [("a", None, "b", "", f"s{i % 3}", i * DAY // 2 if i % 7 else None) for i in range(60)] + [(None, None, None, None, None, 0)] * 3
    df, kept = spark.createDataFrame(rows, EDGES), partials.edge_partials(spark, str(tmp_path / "p"))
    parts = [df.where(f"pmod(xxhash64(requestInTs, serviceCode), 3) = {k}") for k in range(3)]
    for k, part in enumerate(parts):
        kept.add(partials.edges_by_day(part), k)
    kept.add(partials.edges_by_day(parts[1]), 1)  # a repeated batch replaces itself
    assert same(partials.edges_of(kept), network.edges(df))
    some = df.where(f"requestInTs >= {2 * DAY} and requestInTs < {5 * DAY}")
    assert same(partials.edges_of(kept, "1970-01-03", "1970-01-05"), network.edges(some))
    kept.add(partials.edges_by_day(df.where("false")), 9)
    assert same(partials.edges_of(kept), network.edges(df))


def test_report_from_partials_equals_the_whole(spark, tmp_path):
    rows = [("x", "g", str(i % 3), None if i % 4 else "s", "x", "g", str(i % 2), "t", f"op{i % 2}" if i % 9 else "getWsdl", None, None if i % 5 == 0 else i % 3 > 0, i * DAY // 3, i if i % 6 else None, 2 * i, None, i, 3 * i, i) for i in range(80)]
    names = [*SERVICE_CALL, "succeeded", "requestInTs", "totalDuration", "producerDurationProducerView", "clientRequestSize", "producerRequestSize", "clientResponseSize", "producerResponseSize"]
    df = spark.createDataFrame(rows, ", ".join(f"{c} {'string' if c in SERVICE_CALL else 'boolean' if c == 'succeeded' else 'long'}" for c in names))
    kept = partials.report_partials(spark, str(tmp_path / "p"))
    for k in range(3):
        kept.add(partials.report_by_day(df.where(f"requestInTs % 3 = {k}" if k else "coalesce(requestInTs % 3, 0) = 0")), k)
    assert same(partials.report_of(kept), report.report_rows(df))


LINES = ['{"_id": "1", "xRequestId": "a", "securityServerType": "Client", "requestInTs": 5}', '{"_id": "2", "requestInTs": "five"}', '{"_id": "3"', "[]", '[{"_id": "4"}]', "17", "null", "", "   ", "no json", '{"other": 1}', ' {"_id": "7"} ', '{"_id": "é😀"}', "{" + " " * 100_000 + "}"]


def test_each_line_is_read_or_quarantined(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(LINES))
    lines = tables.landed_lines(spark, str(tmp_path / "in"))
    good, bad = tables.parsed_lines(lines)
    assert good.columns == [f.name for f in RAW]
    assert good.count() + bad.count() == lines.count() == sum(bool(x.strip()) for x in LINES)
    assert sorted(r["_id"] or "" for r in good.collect()) == ["", "", "1", "7", "é😀"]
    assert sorted(r.line for r in bad.collect()) == sorted([LINES[1], LINES[2], "[]", '[{"_id": "4"}]', "17", "null", "no json"]) and all(r.file.endswith("a.json") for r in bad.collect())
    assert tables.read_raw(spark, str(tmp_path / "in"), str(tmp_path / "bad")).count() == 5 and spark.read.parquet(str(tmp_path / "bad")).count() == 7


def test_the_loop_sets_broken_lines_aside(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(LINES))
    store = CleanStore(spark, str(tmp_path / "store"), 2)
    correction_loop(store, tables.stream_lines(spark, str(tmp_path / "in")), str(tmp_path / "check"), now=lambda: 5.0, days=None, quarantine=str(tmp_path / "bad")).awaitTermination()
    assert [r.xRequestId for r in store.read().collect()] == ["a"]
    assert store.counters().collect()[0].invalid == 4 and spark.read.parquet(str(tmp_path / "bad")).count() == 7


def test_a_grown_schema_is_one_table_and_a_clash_fails(spark, tmp_path):
    log = tables.LogTable(spark, str(tmp_path / "log"))
    row = lambda **kw: spark.createDataFrame([tuple(kw.values())], ", ".join(f"{k} {'string' if isinstance(v, str) else 'long'}" for k, v in kw.items()))
    log.write(row(requestInTs=0, a="x"))
    log.write(row(requestInTs=DAY, b=5, a="y"))
    log.write(row(requestInTs=2 * DAY, c="z"))
    assert sorted((r.requestInTs, r.a, r.b, r.c) for r in log.read().collect()) == [(0, "x", None, None), (DAY, "y", 5, None), (2 * DAY, None, None, "z")]
    assert len(log.versions()) == 3
    log.write(row(requestInTs=3 * DAY, a="again"))
    assert len(log.versions()) == 3
    for wrong in (row(requestInTs=0, a=1), row(requestInTs=0, A="x"), row(requestInTs=0, requestInDate="1970-01-01").drop("requestInDate").withColumn("b", F.lit(1.5))):
        with pytest.raises(ValueError):
            log.write(wrong)
    assert log.read().count() == 4


def test_snapshots_are_only_appended(spark, tmp_path):
    path = str(tmp_path / "s")
    for day, rows in ((1, [(1, "a")]), (3, [(3, None), (4, "b")]), (2, [(2, "a")])):
        stats.append_snapshot(spark.createDataFrame(rows, "n long, service string"), path, dt.datetime(2024, 1, day))
    assert sorted((r.n, r.service) for r in stats.latest_statistics(spark, path, "n long, service string, later long").collect()) == [(3, None), (4, "b")]
    assert spark.read.parquet(path).count() == 4 and spark.read.parquet(path).where("statistics = '{\"n\":3,\"service\":null}'").count() == 1


def test_report_files_by_table(spark, tmp_path):
    rows = [(("x", "g", "1", None), role, "a,b", None, 1, 0, 1.0, 1, 1, 1, 1, 1, 1, 1, 1) for role in ("ps", "pms", "cs", "cms")]
    df = spark.createDataFrame(rows, "subsystem struct<instance:string,memberClass:string,memberCode:string,subsystemCode:string>, role string, key1 string, key2 string, succeeded long, failed long, mean_duration double, min_duration long, max_duration long, min_request long, mean_request long, max_request long, min_response long, mean_response long, max_response long")
    tables.report_csv(report.display(df), str(tmp_path), "2024-01-01", "2024-01-31")
    for name, first, second in tables.REPORT_TABLES.values():
        r = spark.read.option("header", True).csv(f"{tmp_path}/{name}/2024-01-01_2024-01-31").collect()
        assert len(r) == 1 and (r[0][first], r[0][second], r[0].subsystem, r[0].duration_text) == ("a,b", None, "x/g/1", "1 / 1 / 1")


@pytest.mark.parametrize("day, month, week, following", [
    ("2024-02-29", ("2024-02-01", "2024-02-29"), ("2024-02-19", "2024-02-25"), ("2024-03-04", "2024-03-10")),
    ("2024-03-30", ("2024-02-01", "2024-02-29"), ("2024-03-18", "2024-03-24"), ("2024-04-01", "2024-04-07")),
    ("2024-12-29", ("2024-11-01", "2024-11-30"), ("2024-12-23", "2024-12-29"), ("2024-12-30", "2025-01-05")),
    ("2024-01-01", ("2023-12-01", "2023-12-31"), ("2023-12-25", "2023-12-31"), ("2024-01-01", "2024-01-07")),
    (None, (None, None), (None, None), (None, None)),
])
def test_calendar(spark, day, month, week, following):
    d = F.lit(day).cast("date")
    text = lambda pair: tuple(None if v is None else str(v) for v in spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(pair)]).first())
    assert (text(calendar.previous_month(d)), text(calendar.previous_week(d)), text(calendar.next_week(d))) == (month, week, following)


def test_training_start_and_offsets(spark):
    at = F.lit("2024-05-31 10:20:30").cast("timestamp")
    one = lambda c: str(spark.range(1).select(c.cast("string")).first()[0])
    assert one(calendar.training_start(at, 3, "MONTHS")) == "2024-02-29 10:20:30"
    assert one(calendar.training_start(at, 2, "WEEKS")) == "2024-05-17 10:20:30"
    with pytest.raises(ValueError):
        calendar.training_start(at, 1, "YEARS")
    texts = ["2024-01-31T12:00:00+0300", "2024-01-31T12:00:00 03:00", "2024-01-31T09:00:00Z", "2024-01-31T12:00:00", "2024-02-30T12:00:00Z", "x", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", F.unix_seconds(calendar.with_offset(F.col("t"))).alias("s"))
    assert [r.s for r in df.orderBy("i").collect()] == [1706691600] * 3 + [None] * 5


def test_harvest_parameters(spark):
    source = query.HarvestSource("2024-01-01T00:00:00", 2, tz_offset="+0200")
    assert source.params() == {"from_dt": "2024-01-01T00:00:00+0200", "limit": 2}
    assert source.params(offset=4)["offset"] == 4 and source.resumed(None) == source.params() == source.resumed({"requestInTs": None, "id": None})
    for wrong in ({"limit": 9}, {"from_dt": "2024-01-01"}, {"until_dt": "soon"}):
        with pytest.raises(ValueError):
            source.params(**wrong)
    start = 1704060000000
    df = spark.createDataFrame([(i, start + i // 2 * 1000 + i) for i in range(6)] + [(9, None), (10, start - 1)], "id long, requestInTs long")
    first = query.harvest_page(df, source.params())
    assert [r.id for r in first.collect()] == [0, 1]
    more = source.resumed(query.resume_point(first).first().asDict())
    assert [r.id for r in query.harvest_page(df, more).collect()] == [2, 3] and [r.id for r in query.harvest_page(df, {**more, "offset": 2}).collect()] == [4, 5]


def test_only_flagged_windows_gather_ids(spark):
    rows = [(f"{h}-{i}", h * HOUR + i, not (h == 3 and i < 9), "m" if i < 2 and h == 5 else f"m{h}-{i}", -3000 if h == 4 and i == 1 else 1) for h in range(8) for i in range(10)]
    df = calls(spark, rows)
    found = anomaly.failed_ratio(df, 0.5).collect()
    assert [(r.period_start_time.hour, len(r.request_ids)) for r in found] == [(3, 9)] and found[0].request_ids == sorted(f"3-{i}" for i in range(9))
    assert [r.request_ids for r in anomaly.duplicate_ids(df).collect()] == [["5-0", "5-1"]] and [r.request_ids for r in anomaly.time_sync(df).collect()] == [["4-1"]]
    plan = anomaly.failed_ratio(df, 0.5)._jdf.queryExecution().optimizedPlan().toString()
    gathers = next(line for line in plan.splitlines() if "collect_list" in line)
    assert plan.count("collect_list") == 1 and "LeftSemi" in plan[plan.index(gathers) :]


def test_detectors_on_nulls_and_on_nothing(spark):
    df = calls(spark, [("1", 0, None, None, None), ("2", 1, False, None, None), ("3", None, None, "m", 1), (None, 5, False, None, 2)])
    assert [(r.request_count, r.request_ids) for r in anomaly.duplicate_ids(df).collect()] == [(3.0, ["1", "2"])]
    assert {r.monitored_metric_value for r in anomaly.failed_ratio(df, 0.1).collect()} == {2 / 3}
    none = df.where("false")
    for f in (anomaly.failed_ratio, anomaly.duplicate_ids, anomaly.time_sync, anomaly.historic_averages, anomaly.first_requests):
        assert f(none).count() == 0
    model = anomaly.PeriodModel()
    fitted = model.fit(anomaly.historic_averages(df.where("requestInTs is not null")))
    assert same(model.update(fitted, anomaly.historic_averages(none)).drop("version"), fitted.drop("version"))
    found = model.anomalies(anomaly.historic_averages(df), fitted.where("false"), "request_count", calls=df).collect()
    assert sorted(len(r.request_ids) for r in found) == [1, 2]


def test_an_updated_model_is_shuffled_once(spark):
    model = anomaly.PeriodModel(metrics=["request_count"])
    frame = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10), 2)], "period timestamp, request_count long").withColumns({c: F.lit("x") for c in SERVICE_CALL})
    kept = spark.createDataFrame(model.fit(frame).collect(), model.fit(frame).schema)
    plan = model.update(kept, frame)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_calendar_counts_tell_keys_apart_once(spark):
    now = dt.datetime(2024, 3, 15)
    ms = lambda *d: int(dt.datetime(*d, tzinfo=dt.timezone.utc).timestamp() * 1000)
    rows = [("a", ms(2024, 3, 15), "s"), ("a", ms(2024, 2, 1), "s"), ("a", ms(2024, 3, 15), "s"), ("b", ms(2023, 5, 5), "s"), (None, ms(2024, 3, 1), "s"), ("c", None, "s"), ("d", ms(2024, 3, 1), None)]
    df = spark.createDataFrame(rows, "_id string, requestInTs long, serviceSubsystemCode string")
    assert tuple(stats.calendar_counts(df, now, key="_id").first()) == (4, 1, 2, 1, 2, 1)
    got = {r.serviceSubsystemCode: tuple(r)[1:] for r in stats.service_calendar(df, now, ["s", "gone", "s"]).collect()}
    assert got == {"s": (3, 1, 1, 1, 1, 1), "gone": (0,) * 6}
    assert tuple(stats.calendar_counts(df.where("false"), now, key="_id").first()) == (0,) * 6


def test_classified_agrees_with_split(spark):
    rows = [(f"r{i}", None if i % 11 == 0 else str(i % 9), (None, "Client", "producer", "Proxy", "CLIENT")[i % 5], i % 4 or None) for i in range(80)]
    df = spark.createDataFrame(rows, "_id string, xRequestId string, securityServerType string, requestInTs long")
    want = correct.split_records(df)
    got = correct.classified(df)
    for kind, part in {"first": "first", "duplicate": "duplicates", "faulty": "faulty", "invalid": "invalid"}.items():
        assert {r["_id"] for r in got.where(f"kind = '{kind}'").collect()} == {r["_id"] for r in want[part].collect()}, kind


def test_logs_by_day_and_host(spark, tmp_path):
    df = spark.createDataFrame([(0, "a", 1), (1, "a", 2), (DAY, None, 3), (None, "b", 4)], "requestInTs long, securityServerInternalIp string, n long")
    tables.host_logs(df.coalesce(1), str(tmp_path / "logs"), most=1)
    back = spark.read.json(str(tmp_path / "logs"))
    assert sorted((str(r.date), r.host, r.n) for r in back.collect()) == [("1970-01-01", "a", 1), ("1970-01-01", "a", 2), ("1970-01-02", "unknown", 3), ("None", "b", 4)]
    assert len(list((tmp_path / "logs" / "date=1970-01-01" / "host=a").glob("*.json"))) == 2


def test_members_of_a_descriptor(spark, tmp_path):
    (tmp_path / "d.json").write_text('[{"x_road_instance": "EX", "member_class": "GOV", "member_code": "1", "member_name": "One", "subsystem_code": "a"},\n {"member_code": "1", "member_name": "One", "subsystem_code": "b"}, {"member_code": "2"}]')
    d = tables.read_descriptor(spark, str(tmp_path / "d.json"))
    assert sorted((r.member_code, r.member_name) for r in tables.member_names(d).collect()) == [("1", "One"), ("2", None)]
    assert tables.subsystem(d, "EX", "GOV", "1", "a").count() == 1 and tables.subsystem(d, "EX", "GOV", "1", "z").count() == 0


def test_a_report_is_computed_once_for_its_four_tables(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    def row(i):
        made.add(1)
        return ("s", ("ps", "pms", "cs", "cms")[i % 4], f"k{i}", "x", i, 1, 0, "", "", "")

    columns = "subsystem string, role string, key1 string, key2 string, no int, succeeded long, failed long, duration_text string, request_text string, response_text string"
    tables.report_csv(spark.createDataFrame(spark.sparkContext.range(8).map(row), columns), str(tmp_path), "a", "b")
    assert made.value == 8
    assert {name: spark.read.option("header", True).csv(str(tmp_path / name / "a_b")).count() for name, *_ in tables.REPORT_TABLES.values()} == {name: 2 for name, *_ in tables.REPORT_TABLES.values()}

"""The telemetry domain on the driver's star schema: raw records of both sides, calls, clean calls.

Orders are the client's records and line items the producer's, so that duplicates, orphans on either side and missing
request ids occur. The same SQL text serves Spark and the oracle; only the clock function differs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import correct

#: When a batch runs, in seconds.
NOW = 1_000_000_000.0

_IDS = """
  'EX' AS clientXRoadInstance, CASE WHEN {k} % 2 = 0 THEN 'GOV' ELSE 'COM' END AS clientMemberClass, CAST({k} % 40 AS STRING) AS clientMemberCode,
  CASE WHEN {k} % 13 = 0 THEN NULL ELSE 'sub' || CAST({k} % 5 AS STRING) END AS clientSubsystemCode,
  'EX' AS serviceXRoadInstance, CASE WHEN {k} % 3 = 0 THEN 'GOV' ELSE 'COM' END AS serviceMemberClass, CAST({k} % 30 AS STRING) AS serviceMemberCode,
  CASE WHEN {k} % 17 = 0 THEN NULL ELSE 'sub' || CAST({k} % 4 AS STRING) END AS serviceSubsystemCode,
  CASE {k} % 20 WHEN 0 THEN 'getWsdl' WHEN 1 THEN 'listMethods' ELSE 'op' || CAST({k} % 7 AS STRING) END AS serviceCode,
  CASE WHEN {k} % 5 = 0 THEN NULL ELSE 'v' || CAST({k} % 3 AS STRING) END AS serviceVersion,
  'm' || CAST({k} % 4000 AS STRING) AS messageId,
  CASE {k} % 8 WHEN 0 THEN '7.6.2' WHEN 1 THEN '7.6.1' WHEN 2 THEN '7.7.0' WHEN 3 THEN NULL WHEN 4 THEN '7.a.2' WHEN 5 THEN '7.6' WHEN 6 THEN '7.6.2.1' ELSE '762' END AS xRoadVersion"""

_RAW = """
SELECT 'c' || CAST(o_orderkey AS STRING) AS _id, CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE CAST(o_orderkey AS STRING) END AS xRequestId,
  CASE o_orderkey % 3 WHEN 0 THEN 'Client' WHEN 1 THEN 'CLIENT' ELSE 'client' END AS securityServerType,
  t AS requestInTs, t + o_orderkey % 50 AS requestOutTs, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE t + 60 + o_orderkey % 200 END AS responseInTs, t + 270 + o_orderkey % 7 AS responseOutTs,
  CAST(floor(o_totalprice) AS BIGINT) AS requestSize, CAST(floor(o_totalprice) AS BIGINT) + 100 AS requestMimeSize, CAST(floor(o_totalprice) AS BIGINT) % 5000 AS responseSize, CAST(floor(o_totalprice) AS BIGINT) % 5000 + 50 AS responseMimeSize,
  CASE WHEN o_orderkey % 5 = 4 THEN NULL ELSE CAST(o_orderkey % 4 - 1 AS INT) END AS requestAttachmentCount, CAST(o_orderkey % 3 AS INT) AS responseAttachmentCount,
  o_orderstatus <> 'F' AS succeeded, CASE WHEN o_orderstatus = 'F' THEN 'a<b & ' || o_orderpriority || '>' END AS faultString,
  CASE WHEN o_orderkey % 6 = 0 THEN '/a/' || CAST(o_orderkey % 100 AS STRING) END AS restPath,
  {ids}
FROM (SELECT *, {ms}(o_orderdate) + o_orderkey % 86400 * 1000 AS t FROM {orders}) o
UNION ALL
SELECT 'p' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) || '-' || CAST(CAST(floor(l_quantity) AS BIGINT) AS STRING) || '-' || CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS STRING),
  CASE WHEN l_orderkey % 101 = 0 THEN NULL ELSE CAST(l_orderkey AS STRING) END,
  CASE l_orderkey % 4 WHEN 0 THEN 'Producer' WHEN 1 THEN 'PRODUCER' WHEN 2 THEN CASE WHEN l_orderkey % 202 = 2 THEN 'Proxy' ELSE 'producer' END ELSE 'Producer' END,
  t, t + 3, t + 3 + CAST(floor(l_quantity) AS BIGINT), t + 10 + CAST(floor(l_quantity) AS BIGINT),
  CAST(floor(l_extendedprice) AS BIGINT), CAST(floor(l_extendedprice) AS BIGINT) + 7, CAST(floor(l_extendedprice) AS BIGINT) % 900, CAST(floor(l_extendedprice) AS BIGINT) % 900 + 9,
  CAST(l_linenumber - 2 AS INT), CAST(l_linenumber % 2 AS INT), l_returnflag <> 'R', NULL, CASE WHEN l_orderkey % 12 = 0 THEN '/a/*' END,
  {line_ids}
FROM (SELECT *, {ms}(l_shipdate) + l_orderkey % 1000 AS t FROM {lineitem}) l"""

_CALLS = """
SELECT CAST(event_id AS STRING) AS _id, event_id AS id, {ms}(ts) AS requestInTs, event_type <> 'error' AS succeeded,
  CAST({k} AS STRING) AS messageId, {ids},
  CAST(floor(value * 10) AS BIGINT) AS requestSize, CASE WHEN event_id % 9 = 0 THEN NULL ELSE CAST(floor(value) AS BIGINT) END AS responseSize,
  CAST(floor(value) AS BIGINT) AS totalDuration, CASE WHEN event_type = 'view' THEN NULL ELSE CAST(floor(value / 2) AS BIGINT) END AS producerDurationProducerView,
  CAST(floor(value) AS BIGINT) * 20 - 2300 AS requestNwDuration, CAST(floor(value) AS BIGINT) - 10 AS responseNwDuration
FROM {events}"""
_CALL_IDS = """'EX' AS clientXRoadInstance, 'GOV' AS clientMemberClass, CAST(user_id % 6 AS STRING) AS clientMemberCode, CASE WHEN user_id % 6 = 5 THEN NULL ELSE 'sub' || CAST(user_id % 2 AS STRING) END AS clientSubsystemCode,
  'EX' AS serviceXRoadInstance, 'COM' AS serviceMemberClass, CAST(user_id % 4 AS STRING) AS serviceMemberCode, 'svc' AS serviceSubsystemCode, 'op' || CAST(user_id % 3 AS STRING) AS serviceCode, 'v1' AS serviceVersion"""


def raw_sql(ms: str, orders: str = "orders", lineitem: str = "lineitem") -> str:
    return _RAW.format(ms=ms, orders=orders, lineitem=lineitem, ids=_IDS.format(k="o_orderkey"), line_ids=_IDS.format(k="l_orderkey"))


def calls_sql(ms: str, events: str = "events", k: str = "json_extract_string(props, '$.k')") -> str:
    return _CALLS.format(ms=ms, events=events, k=k, ids=_CALL_IDS)


def _ms(column: str) -> str:
    return f"unix_millis(CAST({column} AS TIMESTAMP))"


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    text = raw_sql("MS").replace("MS(o_orderdate)", _ms("o_orderdate")).replace("MS(l_shipdate)", _ms("l_shipdate"))
    text = text.replace("FROM orders", "FROM {orders}").replace("FROM lineitem", "FROM {lineitem}")
    return spark.sql(text, orders=spark.read.parquet(f"{sf_dir}/orders.parquet"), lineitem=spark.read.parquet(f"{sf_dir}/lineitem.parquet"))


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    text = calls_sql("MS", k="get_json_object(props, '$.k')").replace("MS(ts)", _ms("ts")).replace("FROM events", "FROM {events}")
    return spark.sql(text, events=spark.read.parquet(f"{sf_dir}/events.parquet"))


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return correct.correct_batch(raw(spark, sf_dir), NOW)["clean"]


#: Oracle fragments: the raw records, those ranked by side, first ones, and pairs with derived values.
O_RAW = f"raw AS ({raw_sql('epoch_ms')})"
O_FIRST = f"""{O_RAW},
ranked AS (SELECT *, row_number() OVER (PARTITION BY xRequestId, lower(securityServerType) ORDER BY requestInTs NULLS FIRST, _id) AS place FROM raw WHERE coalesce(xRequestId, '') <> '' AND lower(securityServerType) IN ('client', 'producer')),
c AS (SELECT * FROM ranked WHERE place = 1 AND lower(securityServerType) = 'client'),
p AS (SELECT * FROM ranked WHERE place = 1 AND lower(securityServerType) = 'producer')"""
O_CALLS = f"calls AS ({calls_sql('MS').replace('MS(ts)', '(epoch_us(ts) // 1000)')})"

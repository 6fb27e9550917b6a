"""Columns of the records: raw (one side of a call), clean (both sides) and service-call identifiers."""

from __future__ import annotations

from pyspark.sql import types as T

CLIENT_ID = ["clientXRoadInstance", "clientMemberClass", "clientMemberCode", "clientSubsystemCode"]
SERVICE_ID = ["serviceXRoadInstance", "serviceMemberClass", "serviceMemberCode", "serviceSubsystemCode", "serviceCode", "serviceVersion"]
#: A service call: who calls what. Missing parts group as "-".
SERVICE_CALL = CLIENT_ID + SERVICE_ID

# Fixed values of the record format: the names of its fields.
_STRINGS = [
    "_id", "xRequestId", "securityServerType", *SERVICE_CALL, "representedPartyClass", "representedPartyCode", "messageId", "messageUserId", "messageIssue",
    "messageProtocolVersion", "securityServerInternalIp", "clientSecurityServerAddress", "serviceSecurityServerAddress", "faultCode", "faultString",
    "serviceType", "restMethod", "restPath", "xRoadVersion",
]
_LONGS = [
    "monitoringDataTs", "requestInTs", "requestOutTs", "responseInTs", "responseOutTs", "requestSize", "requestMimeSize", "responseSize", "responseMimeSize",
    "requestSoapSize", "requestRestSize", "responseSoapSize", "responseRestSize",
]
RAW = T.StructType(
    [T.StructField(c, T.StringType()) for c in _STRINGS]
    + [T.StructField(c, T.LongType()) for c in _LONGS]
    + [T.StructField(c, T.IntegerType()) for c in ("requestAttachmentCount", "responseAttachmentCount")]
    + [T.StructField("succeeded", T.BooleanType()), T.StructField("insertTime", T.DoubleType()), T.StructField("corrected", T.BooleanType())]
)

DURATIONS = [
    "totalDuration", "clientSsRequestDuration", "clientSsResponseDuration", "producerDurationClientView", "producerDurationProducerView",
    "producerSsRequestDuration", "producerSsResponseDuration", "producerIsDuration", "requestNwDuration", "responseNwDuration",
]
SIZES = ["clientRequestSize", "producerRequestSize", "clientResponseSize", "producerResponseSize"]


"""From raw records to clean calls: first record per side, pairing, derived values, late partners, timeouts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expr as X
from ..schema import DURATIONS, SIZES

REST_UNKNOWN = "/*"


def normalised(raw: DataFrame) -> DataFrame:
    """Escape text, impute sizes and service type from older fields, gate restPath by version.

    A zero SOAP size falls through to the REST size.
    """
    have = set(raw.columns)
    out = raw.withColumns({c: X.escape_html(F.col(c)) for c, t in raw.dtypes if t == "string" and c not in ("_id", "xRequestId")})
    for side in ("request", "response"):
        if {f"{side}SoapSize", f"{side}RestSize"} <= have:
            old = F.coalesce(F.nullif(F.col(f"{side}SoapSize"), F.lit(0)), F.col(f"{side}RestSize"))
            out = out.withColumn(f"{side}Size", F.coalesce(f"{side}Size", old))
    if {"serviceType", "requestSoapSize", "requestRestSize"} <= have:
        kind = F.when(F.col("requestSoapSize") > 0, "WSDL").when(F.col("requestRestSize") > 0, "REST")
        out = out.withColumn("serviceType", F.coalesce("serviceType", kind))
    if {"restPath", "xRoadVersion"} <= have:
        out = out.withColumn("restPath", F.when(X.version_at_least(F.col("xRoadVersion"), (7, 6, 2)), F.col("restPath")))
    return out


def party(kind: str = "securityServerType") -> Column:
    return F.lower(F.col(kind))


def ranked_records(raw: DataFrame, tie: Sequence[str] = ("_id",), dealt: bool = False) -> DataFrame:
    """raw with `place`: 1 for the first record of its request and side by time, more for duplicates.

    Ranks need every record of a request together; a request has a handful. Records are dealt by request id alone, so that
    what pairs them later needs no further shuffle. dealt: they are so already, as by `shared.dealt`.
    """
    order = Window.partitionBy("xRequestId", party()).orderBy("requestInTs", *tie)
    return (raw if dealt else raw.repartition("xRequestId")).withColumn("place", F.row_number().over(order))


def split_records(raw: DataFrame, tie: Sequence[str] = ("_id",), dealt: bool = False) -> dict[str, DataFrame]:
    """first (of each request and side), duplicates, faulty (without request id) and invalid (neither side) records."""
    known = F.coalesce(party().isin("client", "producer"), F.lit(False))
    named = X.blank_to_null(F.col("xRequestId")).isNotNull()
    ranked = ranked_records(raw.where(known & named), tie, dealt)
    return {
        "first": ranked.where("place = 1").drop("place"),
        "duplicates": ranked.where("place > 1").drop("place"),
        "faulty": raw.where(known & ~named),
        "invalid": raw.where(~known),
    }


def classified(raw: DataFrame, tie: Sequence[str] = ("_id",)) -> DataFrame:
    """raw with `kind` in one pass: first (of its request and side), duplicate, faulty (without request id) or invalid.

    Only records that can have duplicates are dealt by request; the others are dealt by their own content.
    """
    known = F.coalesce(party().isin("client", "producer"), F.lit(False))
    named = X.blank_to_null(F.col("xRequestId")).isNotNull()
    alone = F.concat(F.lit("?"), F.xxhash64(*raw.columns).cast("string"))
    dealt = raw.withColumn("__request", F.when(known & named, F.col("xRequestId")).otherwise(alone))
    order = Window.partitionBy("__request", party()).orderBy("requestInTs", *tie)
    kind = F.when(~known, "invalid").when(~named, "faulty").when(F.row_number().over(order) == 1, "first").otherwise("duplicate")
    return dealt.withColumn("kind", kind).drop("__request")


def keyed(raw: DataFrame) -> DataFrame:
    """raw with `fault` (faulty or invalid, null: neither) and `request`, by which records can be dealt.

    request takes the place of xRequestId in sound records; the others are dealt by their own content.
    """
    known = F.coalesce(party().isin("client", "producer"), F.lit(False))
    fault = F.when(~known, "invalid").when(X.blank_to_null(F.col("xRequestId")).isNull(), "faulty")
    alone = F.concat(F.lit("?"), F.xxhash64(*raw.columns).cast("string"))
    out = raw.withColumns({"fault": fault, "request": F.when(fault.isNull(), F.col("xRequestId")).otherwise(alone)})
    return out.withColumn("xRequestId", F.when(F.col("fault").isNotNull(), F.col("xRequestId")))


def placed(records: DataFrame, tie: Sequence[str] = ("_id",)) -> DataFrame:
    """The sound ones of keyed records with their xRequestId and `place`: 1 for the first of its request and side."""
    order = Window.partitionBy("request", party()).orderBy("requestInTs", *tie)
    sound = records.where("fault is null").withColumn("place", F.row_number().over(order))
    return sound.withColumn("xRequestId", F.col("request")).drop("fault", "request")


def paired(first: DataFrame) -> DataFrame:
    """One row a request: xRequestId, client and producer structs (null: missing).

    Both sides come from one pass over the first records: a full outer join of clients and producers without the join.
    """
    record = F.struct(*first.columns)
    one = lambda name: F.first(F.when(party() == name, record), ignorenulls=True).alias(name)
    return first.groupBy("xRequestId").agg(one("client"), one("producer"))


def durations(client: str = "client", producer: str = "producer") -> dict[str, Column]:
    """The ten durations from the four times of either side; null where a time is missing."""
    c, p = (lambda k: F.col(f"{client}.{k}")), (lambda k: F.col(f"{producer}.{k}"))
    d = X.difference
    return {
        "totalDuration": d(c("responseOutTs"), c("requestInTs")),
        "clientSsRequestDuration": d(c("requestOutTs"), c("requestInTs")),
        "clientSsResponseDuration": d(c("responseOutTs"), c("responseInTs")),
        "producerDurationClientView": d(c("responseInTs"), c("requestOutTs")),
        "producerDurationProducerView": d(p("responseOutTs"), p("requestInTs")),
        "producerSsRequestDuration": d(p("requestOutTs"), p("requestInTs")),
        "producerSsResponseDuration": d(p("responseOutTs"), p("responseInTs")),
        "producerIsDuration": d(p("responseInTs"), p("requestOutTs")),
        "requestNwDuration": d(p("requestInTs"), c("requestOutTs")),
        "responseNwDuration": d(c("responseInTs"), p("responseOutTs")),
    }


def sizes(client: str = "client", producer: str = "producer") -> dict[str, Column]:
    out = {}
    for side, name in ((client, "client"), (producer, "producer")):
        for what in ("request", "response"):
            f = lambda k, side=side, what=what: F.col(f"{side}.{what}{k}")
            out[f"{name}{what.capitalize()}Size"] = X.transaction_size(f("AttachmentCount"), f("Size"), f("MimeSize"))
    return out


def rest_paths(pairs: DataFrame) -> DataFrame:
    """A client's path becomes its producer's, else /*; clients without a path keep none."""
    own, other = F.col("client.restPath"), F.col("producer.restPath")
    fixed = F.when(X.blank_to_null(own).isNotNull(), F.coalesce(X.blank_to_null(other), F.lit(REST_UNKNOWN))).otherwise(own)
    return pairs.withColumn("client", F.when(F.col("client").isNotNull(), F.col("client").withField("restPath", fixed)))


def derived(pairs: DataFrame, now: float, keep: Sequence[str] = ()) -> DataFrame:
    """Clean calls: paths fixed, durations and sizes clamped to int, status and matching type set. keep: further columns."""
    out = rest_paths(pairs).withColumns({k: X.clamp_int(v) for k, v in {**durations(), **sizes()}.items()})
    both = F.col("client").isNotNull() & F.col("producer").isNotNull()
    return out.select(
        "client", "producer", "xRequestId", F.coalesce(F.col("client.messageId"), F.col("producer.messageId")).alias("messageId"), *DURATIONS, *SIZES,
        F.lit(now).alias("correctorTime"), F.when(both, "done").otherwise("processing").alias("correctorStatus"), F.when(both, "regular_pair").otherwise("orphan").alias("matchingType"), *keep,
    )


def lost_calls(faulty: DataFrame, now: float) -> DataFrame:
    """Records without request id as calls of one side that are done at once."""
    rows = faulty.withColumn("xRequestId", F.lit(""))
    side = lambda name: F.when(party() == name, F.struct(*rows.columns)).alias(name)
    return derived(rows.select(side("client"), side("producer"), "xRequestId"), now).withColumn("correctorStatus", F.lit("done"))


def completed(both: DataFrame, now: float, keep: Sequence[str] = ()) -> DataFrame:
    """Clean calls and `grew` from rows with xRequestId, old (client, producer, correctorTime, correctorStatus) and the
    new_client and new_producer that came since; either may be null.

    A new partner makes an orphan a pair that is done. Its time moves only if it was still open, so that a call published
    after its timeout isn't published twice.
    """
    grew = F.lit(False)
    for k in ("client", "producer"):
        grew = grew | (F.col(f"new_{k}").isNotNull() & F.col(f"old.{k}").isNull())
    merged = both.select("xRequestId", *[F.coalesce(f"old.{k}", f"new_{k}").alias(k) for k in ("client", "producer")], F.col("old.correctorTime").alias("t"), F.col("old.correctorStatus").alias("s"), grew.alias("grew"), *keep)
    out = derived(merged, now, ["t", "s", "grew", *keep])
    out = out.withColumn("correctorTime", F.when(F.col("t").isNull() | (F.col("grew") & (F.col("s") == "processing")), F.lit(now)).otherwise(F.col("t")))
    return out.withColumn("correctorStatus", F.when(F.col("grew"), F.col("correctorStatus")).otherwise(F.coalesce("s", "correctorStatus"))).drop("t", "s")


def correct_batch(raw: DataFrame, now: float, clean: DataFrame | None = None, dealt: bool = False) -> dict[str, DataFrame]:
    """clean (the whole table after the batch), updates (its rows that the batch made or changed), duplicates and invalid.

    Earlier clean calls win over new records of their side; see `completed` for late partners. dealt: raw is dealt by
    request id already.
    """
    # Ranks need times and ids only; what is ranked out needn't be made ready for the table before the shuffle.
    parts = {kind: normalised(rows) for kind, rows in split_records(raw, dealt=dealt).items()}
    first, duplicates = parts["first"], parts["duplicates"]
    fresh = paired(first)
    lost = lost_calls(parts["faulty"], now)
    if clean is None:
        whole = derived(fresh, now).unionByName(lost)
        return {"clean": whole, "updates": whole, "duplicates": duplicates, "invalid": parts["invalid"]}
    held = clean.where("xRequestId <> ''")
    sides = held.select("xRequestId", F.explode(F.array(F.when(F.col("client").isNotNull(), "client"), F.when(F.col("producer").isNotNull(), "producer"))).alias("side")).where("side is not null")
    duplicates = duplicates.unionByName(first.join(sides, (first["xRequestId"] == sides["xRequestId"]) & (party() == sides["side"]), "left_semi"))
    old = held.select("xRequestId", F.struct("client", "producer", "correctorTime", "correctorStatus").alias("old"))
    new = fresh.select("xRequestId", *[F.col(k).cast(clean.schema[k].dataType).alias(f"new_{k}") for k in ("client", "producer")])
    out = completed(old.join(new, "xRequestId", "full_outer"), now)
    return {"clean": out.drop("grew").unionByName(lost).unionByName(clean.where("xRequestId = ''")), "updates": out.where("grew").drop("grew").unionByName(lost), "duplicates": duplicates, "invalid": parts["invalid"]}


def timed_out(clean: DataFrame, now: float, days: int = 3) -> Column:
    """Open calls whose own side is older than the timeout."""
    limit = (now - days * 86_400) * 1000
    side_old = lambda s: F.col(f"{s}.xRequestId").isNotNull() & (F.col(f"{s}.requestInTs") < limit)
    return F.coalesce((F.col("correctorStatus") == "processing") & (side_old("client") | side_old("producer")), F.lit(False))


def expire(clean: DataFrame, now: float, days: int = 3) -> DataFrame:
    late = timed_out(clean, now, days)
    return clean.withColumns({"correctorTime": F.when(late, F.lit(now)).otherwise(F.col("correctorTime")), "correctorStatus": F.when(late, "done").otherwise(F.col("correctorStatus"))})


def interval_match(left: DataFrame, right: DataFrame, attributes: Sequence[str], window_ms: int = 600_000, time: str = "requestInTs", prefix: str = "match_") -> DataFrame:
    """Pairs of records whose attributes are null-safely equal and whose times differ by at most the window.

    The first attributes are hash keys; buckets of four windows' length are keys as well, so no pair outside of a bucket and
    its margins is compared. A row of the left side, which should be the smaller, stands in each bucket that its window
    touches, half of them in one only; a row of the right side stands in its own.
    """
    length = 4 * window_ms
    r = right.select([F.col(c).alias(prefix + c) for c in right.columns])
    at = lambda t: F.floor(t / length)
    near_by = left.withColumn("__b", F.explode(F.sequence(at(F.col(time) - window_ms), at(F.col(time) + window_ms))))
    same = [near_by[a].eqNullSafe(r[prefix + a]) for a in attributes]
    near = F.abs(near_by[time] - r[prefix + time]) <= window_ms
    on = same + [near_by["__b"] == at(r[prefix + time]), near]
    return near_by.join(r, on).drop("__b")


def first_match(left: DataFrame, right: DataFrame, attributes: Sequence[str], key: Sequence[str], window_ms: int = 600_000, time: str = "requestInTs", tie: str = "_id") -> DataFrame:
    """For each left record the first match by time, then by id."""
    pairs = interval_match(left, right, attributes, window_ms, time)
    order = Window.partitionBy(*key).orderBy(F.col("match_" + time), F.col("match_" + tie))
    return pairs.withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n")

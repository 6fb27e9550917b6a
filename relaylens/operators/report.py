"""Usage reports of all subsystems in one job: role of each call, aggregates, top series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expr as X
from ..schema import CLIENT_ID, SERVICE_ID

# Services that describe services.
META_SERVICES = ("getWsdl", "listMethods", "allowedMethods", "getSecurityServerMetrics", "getSecurityServerOperationalData", "getSecurityServerHealthData", "getOpenAPI")
OWNER = SERVICE_ID[:4]


def flattened(clean: DataFrame, fields: Sequence[str], carried: Sequence[str]) -> DataFrame:
    """Fields of the client's record, or of the producer's where there is no client: the whole struct, not each field."""
    side = F.when(F.col("client").isNotNull(), F.struct(*[F.col(f"client.{f}").alias(f) for f in fields])).otherwise(F.struct(*[F.col(f"producer.{f}").alias(f) for f in fields]))
    return clean.select(side.alias("s"), *carried).select("s.*", *carried)


def with_roles(calls: DataFrame, meta: Sequence[str] = META_SERVICES) -> DataFrame:
    """A row for each subsystem that takes part, with its role: ps, pms (producer, meta service), cs or cms.

    A subsystem that calls itself is the producer of that call only.
    """
    is_meta = F.coalesce(F.col("serviceCode").isin(*meta), F.lit(False))
    me = lambda ids: F.struct(*[F.col(c).alias(n) for c, n in zip(ids, ("instance", "memberClass", "memberCode", "subsystemCode"))])
    producer, consumer = me(OWNER), me(CLIENT_ID)
    entries = F.array(
        F.struct(producer.alias("subsystem"), F.when(is_meta, "pms").otherwise("ps").alias("role")),
        F.when(~producer.eqNullSafe(consumer), F.struct(consumer.alias("subsystem"), F.when(is_meta, "cms").otherwise("cs").alias("role"))),
    )
    return calls.select(F.explode(F.filter(entries, lambda x: x.isNotNull())).alias("e"), *calls.columns).select("e.subsystem", "e.role", *calls.columns)


def role_keys() -> tuple[Column, Column]:
    """For a producer: service and caller; for a consumer: producer and service. Empty parts are left out."""
    service = X.joined(".", F.col("serviceCode"), F.col("serviceVersion"))
    caller = X.joined("/", *[F.col(c) for c in CLIENT_ID])
    owner = X.joined("/", *[F.col(c) for c in OWNER])
    produces = F.col("role").isin("ps", "pms")
    return F.when(produces, service).otherwise(owner), F.when(produces, caller).otherwise(service)


def measures() -> tuple[Column, dict[str, Column]]:
    """Whether a call with a role succeeded, and its duration and sizes as that role sees them."""
    produces = F.col("role").isin("ps", "pms")
    duration = F.when(produces, F.coalesce("producerDurationProducerView", "totalDuration")).otherwise(F.col("totalDuration"))
    return F.coalesce("succeeded", F.lit(False)), {"duration": duration, "request": F.coalesce("clientRequestSize", "producerRequestSize"), "response": F.coalesce("clientResponseSize", "producerResponseSize")}


def report_rows(calls: DataFrame) -> DataFrame:
    """Counts of each role and pair of keys, and least, mean and greatest duration and sizes of what succeeded."""
    first, second = role_keys()
    ok, values = measures()
    duration = values["duration"]
    aggregates = [f(F.when(ok, v)).alias(f"{n}_{k}") for k, v in values.items() for n, f in (("min", F.min), ("mean", F.avg), ("max", F.max))]
    return with_roles(calls).groupBy("subsystem", "role", first.alias("key1"), second.alias("key2")).agg(F.count_if(ok).alias("succeeded"), F.count_if(~ok).alias("failed"), *aggregates, F.sum(F.when(ok, duration)).alias("sum_duration"), F.count(F.when(ok, duration)).alias("n_duration"))


def top_series(rows: DataFrame, by: Sequence[str], name: str, value: Column, n: int = 5) -> DataFrame:
    """The n names of greatest value in each group, equal values by name; nulls and zeros are left out."""
    series = rows.groupBy(*by, name).agg(value.alias("value")).where("value is not null and value > 0")
    order = Window.partitionBy(*by).orderBy(F.desc("value"), name)
    return series.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n)


def succeeded_total() -> Column:
    return F.sum("succeeded")


def weighted_mean_duration() -> Column:
    return F.bround(F.try_divide(F.sum("sum_duration"), F.sum("n_duration")), 0)


def display(rows: DataFrame, keys: Sequence[str] = ("key1", "key2")) -> DataFrame:
    """Rows of each role in case-insensitive order with a running number, and spans as text."""
    order = Window.partitionBy("subsystem", "role").orderBy(*[F.lower(F.col(k)) for k in keys], *keys)
    texts = {k: X.span_text(F.col(f"min_{k}"), F.col(f"mean_{k}"), F.col(f"max_{k}")) for k in ("duration", "request", "response")}
    return rows.withColumn("no", F.row_number().over(order)).withColumns({f"{k}_text": v for k, v in texts.items()})


def unique_subsystems(calls: DataFrame) -> DataFrame:
    """Distinct subsystems of either side; sides without a subsystem code don't count."""
    sides = F.array(*[F.struct(*[F.col(c).alias(n) for c, n in zip(ids, ("instance", "memberClass", "memberCode", "subsystemCode"))]) for ids in (CLIENT_ID, OWNER)])
    return calls.select(F.explode(sides).alias("s")).select("s.*").where("subsystemCode is not null").distinct()


def member_triples(calls: DataFrame) -> DataFrame:
    """Distinct (memberCode, subsystemCode, memberClass) of either side; a missing subsystem is ''."""
    sides = F.array(*[F.struct(F.col(ids[2]).alias("memberCode"), F.coalesce(F.col(ids[3]), F.lit("")).alias("subsystemCode"), F.col(ids[1]).alias("memberClass")) for ids in (CLIENT_ID, OWNER)])
    return calls.select(F.explode(sides).alias("s")).select("s.*").where("memberCode is not null").distinct()


def clean_calls_between(clean: DataFrame, start_ms: int, end_ms: int) -> DataFrame:
    """Clean calls of which the client's or the producer's record lies between the bounds, both counting."""
    return clean.where(F.coalesce(F.col("client.requestInTs").between(start_ms, end_ms), F.lit(False)) | F.coalesce(F.col("producer.requestInTs").between(start_ms, end_ms), F.lit(False)))


def calls_between(calls: DataFrame, start_ms: int, end_ms: int) -> DataFrame:
    """Both bounds count, the end being the midnight after the last day."""
    return calls.where(F.col("requestInTs").between(start_ms, end_ms))

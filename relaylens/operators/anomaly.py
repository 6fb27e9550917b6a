"""Anomaly detection on calls: tumbling aggregates, trained averages per seasonal period, and four detectors.

calls have the ten service-call columns, requestInTs (ms) and what a detector needs. Frames of a window have `period`
(its start as a timestamp).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from ..functions import expr as X
from ..schema import SERVICE_CALL

METRICS = ("request_count", "mean_request_size", "mean_response_size", "mean_client_duration", "mean_producer_duration")
#: A spread of zero is taken for this, so that a score is defined.
LEAST_SPREAD = 0.001


def unified(clean: DataFrame) -> DataFrame:
    """The client's value of each field, else the producer's; missing identifiers become '-'."""
    fields = [*SERVICE_CALL, "requestInTs", "succeeded", "messageId"]
    both = {f: F.coalesce(F.col(f"client.{f}"), F.col(f"producer.{f}")) for f in fields}
    both |= {f: F.coalesce(both[f], F.lit("-")) for f in SERVICE_CALL}
    return clean.select(*[v.alias(k) for k, v in both.items()], F.coalesce("clientRequestSize", "producerRequestSize").alias("requestSize"), F.coalesce("clientResponseSize", "producerResponseSize").alias("responseSize"), "totalDuration", "producerDurationProducerView", "requestNwDuration", "responseNwDuration", F.coalesce("client._id", "producer._id").alias("_id"), "xRequestId")


def windowed(calls: DataFrame, minutes: int) -> DataFrame:
    """calls with null identifiers as '-' and the start of their window."""
    ids = {c: F.coalesce(F.col(c), F.lit("-")) for c in SERVICE_CALL}
    return calls.withColumns({**ids, "period": F.timestamp_millis(X.bucket(F.col("requestInTs"), minutes))})


def by_period(calls: DataFrame, minutes: int, keys: Sequence[str] = ()) -> GroupedData:
    return windowed(calls, minutes).groupBy(*SERVICE_CALL, "period", *keys)


def historic_averages(calls: DataFrame, minutes: int = 60, ids: bool = False) -> DataFrame:
    """Calls and mean sizes and durations of each service call and window. ids: with request_ids, the sorted ids of its calls."""
    return by_period(calls, minutes).agg(
        F.count("*").alias("request_count"), F.avg("requestSize").alias("mean_request_size"), F.avg("responseSize").alias("mean_response_size"),
        F.avg("totalDuration").alias("mean_client_duration"), F.avg("producerDurationProducerView").alias("mean_producer_duration"),
        *([F.sort_array(F.collect_list("_id")).alias("request_ids")] if ids else []),
    )


def with_request_ids(flagged: DataFrame, calls: DataFrame, minutes: int, keys: Sequence[str] = (), condition: Column | None = None) -> DataFrame:
    """Flagged windows with request_ids, the sorted ids of their calls (of those that meet the condition).

    The second phase of detection: windows are flagged by counts alone, and only calls of flagged ones are gathered. Few
    windows are flagged, so the semi join that picks their calls needs no shuffle of the others.
    """
    on = [*SERVICE_CALL, "period", *keys]
    names = [F.col(k).alias(f"__at_{k}") for k in on]
    same = [F.col(k).eqNullSafe(F.col(f"__at_{k}")) for k in on]
    mine = windowed(calls if condition is None else calls.where(condition), minutes).select("_id", *on)
    wanted = flagged.select(*names).distinct()
    ids = mine.join(wanted, same, "left_semi").groupBy(*names).agg(F.sort_array(F.collect_list("_id")).alias("request_ids"))
    out = flagged.join(ids, same, "left").drop(*[f"__at_{k}" for k in on])
    return out.withColumn("request_ids", F.coalesce("request_ids", F.array().cast("array<string>")))


def _end(unit: str) -> Column:
    return F.col("period") + F.expr(f"INTERVAL 1 {unit}")


def _incident(frame: DataFrame, unit: str, metric: str, value: Column, difference: Column, count: Column, confidence: Column, description: Column, keep: Sequence[str] = ()) -> DataFrame:
    return frame.select(
        *SERVICE_CALL, *keep, F.col("period").alias("period_start_time"), _end(unit).alias("period_end_time"), F.lit(metric).alias("anomalous_metric"),
        value.cast("double").alias("monitored_metric_value"), difference.cast("double").alias("difference_from_normal"), count.cast("double").alias("request_count"),
        confidence.cast("double").alias("anomaly_confidence"), F.lit(unit.lower()).alias("aggregation_timeunit"), description.alias("description"), "request_ids",
    )


def failed_ratio(calls: DataFrame, threshold: float = 0.9, minutes: int = 60, unit: str = "HOUR") -> DataFrame:
    """Windows in which the share of failed calls exceeds the threshold, with the ids of the failed ones."""
    failed = ~F.col("succeeded")
    f = by_period(calls, minutes).agg(F.count("*").alias("n"), F.count_if(failed).alias("failed"))
    f = with_request_ids(f.withColumn("ratio", F.col("failed") / F.col("n")).where(F.col("ratio") > threshold), calls, minutes, condition=failed)
    return _incident(f, unit, "failed_request_ratio", F.col("ratio"), F.col("ratio") - threshold, F.col("n"), F.lit(1.0), F.format_string("%d of %d requests failed", "failed", "n"))


def duplicate_ids(calls: DataFrame, minutes: int = 60 * 24, unit: str = "DAY") -> DataFrame:
    """Message ids that occur more than once for a service call and window."""
    f = with_request_ids(by_period(calls, minutes, ["messageId"]).agg(F.count("*").alias("n")).where("n > 1"), calls, minutes, ["messageId"])
    return _incident(f, unit, "duplicate_message_id", F.col("n"), F.col("n") - 1, F.col("n"), F.lit(1.0), F.format_string("message id %s occurs %d times", "messageId", "n"), keep=["messageId"])


def time_sync(calls: DataFrame, metric: str = "requestNwDuration", threshold: float = -2000.0, minutes: int = 60, unit: str = "HOUR") -> DataFrame:
    """Windows with calls whose network time is below the threshold, with the ids of these calls."""
    low = F.col(metric) < threshold
    f = by_period(calls, minutes).agg(F.count("*").alias("n"), F.count_if(low).alias("low"), F.avg(F.when(low, F.col(metric))).alias("mean_low")).where("low > 0")
    f = with_request_ids(f, calls, minutes, condition=low)
    return _incident(f, unit, metric, F.col("mean_low"), -F.col("mean_low"), F.col("n"), F.lit(1.0), F.format_string("%d of %d requests below the limit", "low", "n"))


@dataclass(frozen=True)
class PeriodModel:
    """Means and spreads of each service call and seasonal period, kept as sums so that updates only add.

    parts: of what the period's key is made, e.g. ("hour", "weekday").
    """

    parts: Sequence[str] = ("hour", "weekday")
    metrics: Sequence[str] = METRICS
    confidence: float = 0.95
    keys: Sequence[str] = field(default_factory=lambda: [*SERVICE_CALL, "similar_periods"])

    def with_period(self, frame: DataFrame) -> DataFrame:
        return frame.withColumn("similar_periods", X.similar_period(F.unix_millis("period"), self.parts))

    def names(self) -> list[str]:
        return [f"{m}_{k}" for m in self.metrics for k in ("count", "sum", "ssq")]

    def parts_of(self, frame: DataFrame) -> DataFrame:
        """What each window adds to its period's count, sum and sum of squares of each metric; nulls add nothing."""
        made = []
        for m in self.metrics:
            x = F.col(m).cast("double")
            made += [x.isNotNull().cast("long").alias(f"{m}_count"), F.coalesce(x, F.lit(0.0)).alias(f"{m}_sum"), F.coalesce(x * x, F.lit(0.0)).alias(f"{m}_ssq")]
        return self.with_period(frame).select(*self.keys, *made)

    def sums(self, frame: DataFrame) -> DataFrame:
        return self.parts_of(frame).groupBy(*self.keys).agg(*[F.sum(c).alias(c) for c in self.names()])

    def finished(self, sums: DataFrame) -> DataFrame:
        """Mean and population spread from the sums; below two values the spread is 0."""
        out = {}
        for m in self.metrics:
            n, s, q = (F.col(f"{m}_{k}") for k in ("count", "sum", "ssq"))
            out[f"{m}_mean"] = F.try_divide(s, n)
            out[f"{m}_std"] = F.when(n < 2, 0.0).otherwise(F.sqrt(F.greatest(F.lit(0.0), F.try_divide(q - F.try_divide(s * s, n), n))))
        return sums.withColumns(out)

    def fit(self, frame: DataFrame) -> DataFrame:
        return self.finished(self.sums(frame)).withColumn("version", F.lit(1))

    def update(self, model: DataFrame, frame: DataFrame) -> DataFrame:
        """The model with the new frame's sums added: as if fitted on all. Old sums and new parts meet in one aggregation."""
        new = self.parts_of(frame).withColumn("version", F.lit(0))
        both = model.select(*self.keys, *self.names(), F.coalesce("version", F.lit(0)).alias("version")).unionByName(new)
        added = both.groupBy(*self.keys).agg(*[F.sum(c).alias(c) for c in self.names()], (F.max("version") + 1).alias("version"))
        return self.finished(added).select(*self.keys, *self.names(), "version", *[f"{m}_{k}" for m in self.metrics for k in ("mean", "std")])

    def without(self, model: DataFrame, retrained: DataFrame) -> DataFrame:
        """The model without all periods of service calls that are trained anew."""
        return model.join(retrained, same_call(model, retrained), "left_anti")

    def retrain(self, model: DataFrame, frame: DataFrame, retrained: DataFrame) -> DataFrame:
        """The model in which those service calls are fitted on the frame alone, at the version that the model has."""
        version = F.coalesce(model.agg(F.max("version")).scalar(), F.lit(1))
        fitted = self.fit(frame.join(retrained, same_call(frame, retrained), "left_semi")).withColumn("version", version)
        return self.without(model, retrained).unionByName(fitted)

    def one_a_period(self, model: DataFrame) -> DataFrame:
        """One row a service call and period, that of the lowest version, of a table that several saves went into."""
        rest = [c for c in model.columns if c not in self.keys]
        return model.groupBy(*self.keys).agg(F.min_by(F.struct(*rest), F.struct("version", F.xxhash64(*rest))).alias("r")).select(*self.keys, "r.*")

    def anomalies(self, frame: DataFrame, model: DataFrame, metric: str, unit: str = "HOUR", calls: DataFrame | None = None, minutes: int = 60) -> DataFrame:
        """Windows whose metric lies too far from its period's mean, by a two-sided normal test. calls: of which the ids are taken.

        A period without a model counts as mean 0 and spread 0 for request_count and is skipped for other metrics.
        """
        known = model.select(*[F.col(k).alias(f"__{k}") for k in self.keys], F.col(f"{metric}_mean").alias("__mean"), F.col(f"{metric}_std").alias("__std"), F.col("version").alias("__version"))
        f = self.with_period(frame)
        f = f.join(known, [F.col(k) == F.col(f"__{k}") for k in self.keys], "left")
        if metric == "request_count":
            f = f.withColumns({"__mean": F.coalesce("__mean", F.lit(0.0)), "__std": F.coalesce("__std", F.lit(0.0))})
        spread = F.when(F.col("__std") == 0, LEAST_SPREAD).otherwise(F.col("__std"))
        x = F.col(metric).cast("double")
        # p < 1 - confidence just where |z| exceeds this constant, so the filter needs no error function.
        limit = NormalDist().inv_cdf((1 + self.confidence) / 2)
        f = f.withColumn("z", (x - F.col("__mean")) / spread).where(F.abs("z") > limit)
        said = F.format_string("%s %s its usual value", F.lit(metric), F.when(F.col("z") > 0, "above").otherwise("below"))
        f = with_request_ids(f, calls, minutes) if calls is not None else f.withColumn("request_ids", F.array().cast("array<string>"))
        return _incident(f, unit, metric, F.col(metric), F.abs(x - F.col("__mean")), F.col("request_count"), 1 - X.two_sided_p(F.col("z")), said)


def first_requests(calls: DataFrame) -> DataFrame:
    """First call of each service call."""
    return calls.groupBy(*SERVICE_CALL).agg(F.min("requestInTs").alias("first_request_timestamp"))


def same_call(left: DataFrame, right: DataFrame) -> list[Column]:
    return [left[c].eqNullSafe(right[c]) for c in SERVICE_CALL]


def new_service_calls(calls: DataFrame, known: DataFrame) -> DataFrame:
    """First requests of service calls that aren't known yet."""
    first = first_requests(calls)
    return first.join(known, same_call(first, known), "left_anti")


def only(calls: DataFrame, service_calls: DataFrame) -> DataFrame:
    return calls.join(service_calls, same_call(calls, service_calls), "left_semi")


def confirmed_ids(incidents: DataFrame, status: str = "incident") -> DataFrame:
    """Distinct ids of requests that are part of incidents of that status."""
    return incidents.where(F.col("incident_status") == status).select(F.explode("request_ids").alias("_id")).distinct()


def training_calls(calls: DataFrame, incidents: DataFrame, start_ms: int, end_ms: int) -> DataFrame:
    """Succeeded calls of [start, end) that no confirmed incident holds."""
    t = F.col("requestInTs")
    return calls.where(F.col("succeeded") & (t >= start_ms) & (t < end_ms)).join(confirmed_ids(incidents), "_id", "left_anti")


def staged_training_calls(calls: DataFrame, stages: DataFrame, incidents: DataFrame, start_ms: int, end_ms: int) -> DataFrame:
    """training_calls of all stages together, with their stage: regular ones of [start, end), first trainings and retrainings
    of all time before the end. Calls of waiting or unknown service calls aren't used.
    """
    known = stages.select(*[F.col(c).alias(f"__{c}") for c in SERVICE_CALL], "stage").where("stage <> 'waiting'")
    rows = calls.join(known, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in SERVICE_CALL]).drop(*[f"__{c}" for c in SERVICE_CALL])
    t = F.col("requestInTs")
    rows = rows.where(F.col("succeeded") & (t < end_ms) & ((F.col("stage") != "regular") | (t >= start_ms)))
    return rows.join(confirmed_ids(incidents), "_id", "left_anti")


def analysable(frame: DataFrame, now: dt.datetime, minutes: int = 60, buffer_minutes: int = 14_400) -> DataFrame:
    """Windows that are over, given how late records may come (buffer_minutes): they end by the last full window before."""
    end = int((now - dt.timedelta(minutes=buffer_minutes)).replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    return frame.where(F.unix_millis("period") < end - end % (minutes * 60_000))


def incident_requests(incidents: DataFrame, *by: str) -> DataFrame:
    """The requests of the incidents in sum: one row, 0 without any; or a row for each value of `by` that occurs."""
    return incidents.groupBy(*by).agg(F.coalesce(F.sum("request_count"), F.lit(0)).cast("long").alias("request_count"))


def example_requests(calls: DataFrame, incidents: DataFrame, limit: int) -> DataFrame:
    """The first `limit` calls by time, then id, that incidents hold."""
    return calls.join(incidents.select(F.explode("request_ids").alias("_id")).distinct(), "_id", "left_semi").orderBy("requestInTs", "_id").limit(limit)


def lifecycle_stages(timestamps: DataFrame, now: dt.datetime, train_after: dt.timedelta, retrain_after: dt.timedelta) -> DataFrame:
    """Stage of each service call: first_train, retrain, regular or waiting.

    A first model comes once enough time has passed since the first request; a retraining once enough has passed since
    the first incident and none was done.
    """
    first, trained, incident, again = (F.col(f"first_{k}_timestamp") for k in ("request", "model_train", "incident", "model_retrain"))
    stage = (
        F.when(trained.isNull() & (first <= F.lit(now - train_after)), "first_train")
        .when(trained.isNull(), "waiting")
        .when(again.isNull() & (incident <= F.lit(now - retrain_after)), "retrain")
        .otherwise("regular")
    )
    return timestamps.withColumn("stage", stage)


def set_timestamps(timestamps: DataFrame, service_calls: DataFrame, column: str, value: dt.datetime) -> DataFrame:
    """timestamps with `column` set for the given service calls."""
    s = service_calls.select(*[F.col(c).alias(f"__{c}") for c in SERVICE_CALL], F.lit(True).alias("__hit")).distinct()
    out = timestamps.join(s, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in SERVICE_CALL], "left")
    return out.withColumn(column, F.when(F.col("__hit"), F.lit(value)).otherwise(F.col(column))).select(*timestamps.columns)

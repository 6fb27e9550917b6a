"""Streams: stateful pairing with timeouts and late partners, and tumbling counts.

Batch correction is the source of truth; a stream that has read all records pairs the same sides.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..plans.shared import shared_folder

OUT = "xRequestId string, client_id string, producer_id string, status string, matching string, expired boolean, version int"
#: Requests of a bucket, in parallel arrays.
STATE = "ids array<string>, clients array<string>, producers array<string>, expired array<boolean>, versions array<int>, due array<bigint>"
#: Buckets that requests fall in by hash. A stream can't change it later.
BUCKETS = 4_096
#: An open orphan is done after this long, and what is done is forgotten after a further KEEP_MS.
TIMEOUT_MS = 3 * 86_400_000
KEEP_MS = 30 * 86_400_000
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class CallState(StatefulProcessor):
    """The first record of each side by request, over all batches. Of a bucket of requests the engine keeps one value and one timer.

    Each call of the engine's state costs a round trip to the JVM, so requests share theirs. Timers go by event time, which
    is the time of arrival: an orphan is done at its timeout and may still be completed until it is forgotten, however old
    its partner's own times are. A bucket's timer is that of its request which is due first.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.calls = handle.getValueState("calls", STATE)

    def close(self) -> None:
        pass

    def _read(self) -> dict[str, tuple]:
        """client, producer, expired, version and due time by request."""
        kept = self.calls.get()
        return {} if kept is None else {i: v for i, *v in zip(*kept)}

    def _write(self, calls: dict[str, tuple], timer: int | None) -> None:
        """timer: the bucket's timer that is set; None: none."""
        if not calls:
            self.calls.clear()
        else:
            self.calls.update((list(calls), *map(list, zip(*calls.values()))))
        first = min((v[4] for v in calls.values()), default=None)
        if timer != first:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if first is not None:
                self.handle.registerTimer(first)

    @staticmethod
    def _out(made: list[tuple]) -> pd.DataFrame:
        """Updates from request, client, producer, expired and version."""
        out = pd.DataFrame(made, columns=["xRequestId", "client_id", "producer_id", "expired", "version"])
        both = out["client_id"].notna() & out["producer_id"].notna()
        out["status"] = (both | out["expired"]).map({True: "done", False: "processing"})
        out["matching"] = both.map({True: "regular_pair", False: "orphan"})
        return out[[c.split()[0] for c in OUT.split(", ")]]

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        least, arrived = {}, {}
        for frame in rows:
            for request, id, timed, at, party, came in zip(*(frame[c].tolist() for c in ("xRequestId", "id", "timed", "at", "party", "arrived_ms"))):
                side, order = (request, party), (timed, at, id or "")
                if side not in least or order < least[side][0]:
                    least[side] = (order, id)
                arrived[request] = max(arrived.get(request, 0), came)
        calls = self._read()
        timer = min((v[4] for v in calls.values()), default=None)
        made = []
        for request, came in arrived.items():
            client, producer, expired, version, _ = calls.get(request, (None, None, False, 0, 0))
            grew = False
            if client is None and (request, "client") in least:
                client, grew = least[request, "client"][1], True
            if producer is None and (request, "producer") in least:
                producer, grew = least[request, "producer"][1], True
            if grew:
                closed = expired or client is not None and producer is not None
                calls[request] = (client, producer, expired, version + 1, came + (KEEP_MS if closed else TIMEOUT_MS))
                made.append((request, client, producer, expired, version + 1))
        if made:
            self._write(calls, timer)
            yield self._out(made)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        calls, now, made = self._read(), timerValues.getCurrentWatermarkInMs(), []
        for request, (client, producer, expired, version, due) in list(calls.items()):
            if due > now:
                continue
            if expired or client is not None and producer is not None:
                del calls[request]
            else:
                calls[request] = (client, producer, True, version + 1, due + KEEP_MS)
                made.append((request, client, producer, True, version + 1))
        self._write(calls, None)  # the engine deletes the timer that has fired
        if made:
            yield self._out(made)


def pair_stream(records: DataFrame, arrived: str = "arrived", late: str = "1 hour", buckets: int = BUCKETS) -> DataFrame:
    """Updates of pairs by request from a stream of raw records; the highest version of a request counts.

    arrived: a timestamp of arrival, late: how far behind the latest arrival one may be. Needs the RocksDB state store.
    """
    rows = records.where("coalesce(xRequestId, '') <> '' and lower(securityServerType) in ('client', 'producer')").withWatermark(arrived, late)
    bucket = F.pmod(F.xxhash64("xRequestId"), F.lit(buckets)).cast("int").alias("bucket")
    rows = rows.select(bucket, "xRequestId", F.col("_id").alias("id"), F.col("requestInTs").isNotNull().alias("timed"), F.coalesce("requestInTs", F.lit(0)).alias("at"), F.lower("securityServerType").alias("party"), F.unix_millis(arrived).alias("arrived_ms"), arrived)
    return rows.groupBy("bucket").transformWithStateInPandas(CallState(), OUT, "Update", "EventTime")


def latest_updates(updates: DataFrame) -> DataFrame:
    order = Window.partitionBy("xRequestId").orderBy(F.desc("version"))
    return updates.withColumn("n", F.row_number().over(order)).where("n = 1").drop("n")


def run_to_end(stream: DataFrame, mode: str, path: str) -> DataFrame:
    """Run over all that is there now; each micro-batch overwrites its own folder, so a repeated batch counts once."""
    spark = stream.sparkSession

    def write(df: DataFrame, epoch: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/out/batch={epoch}")

    stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/out")


def run_pairing(spark: SparkSession, steps: list[DataFrame]) -> DataFrame:
    """Pairs after a stream has read each of the steps (raw records with `arrived`) in turn, to its end and on from there."""
    path, key = shared_folder(spark), "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, ROCKSDB)
    try:
        for n, step in enumerate(steps):
            step.select("_id", "xRequestId", "securityServerType", "requestInTs", "arrived").write.parquet(f"{path}/in/{n}")
            source = spark.readStream.schema("_id string, xRequestId string, securityServerType string, requestInTs long, arrived timestamp").parquet(f"{path}/in/*")
            out = run_to_end(pair_stream(source), "update", path)
    finally:
        spark.conf.set(key, before)
    return latest_updates(out)


def run_tumbling(spark: SparkSession, calls: DataFrame, minutes: int = 60) -> DataFrame:
    path = shared_folder(spark)
    calls.select("requestInTs", "succeeded").write.parquet(f"{path}/in")
    source = spark.readStream.schema("requestInTs long, succeeded boolean").parquet(f"{path}/in")
    counted = source.select(F.timestamp_millis("requestInTs").alias("at"), "succeeded").withWatermark("at", "10 days")
    counted = counted.groupBy(F.window("at", f"{minutes} minutes")).agg(F.count("*").alias("n"), F.count_if(~F.col("succeeded")).alias("failed"))
    flat = counted.select(F.unix_millis("window.start").alias("period_ms"), "n", "failed")
    out = run_to_end(flat, "update", path)
    return out.groupBy("period_ms").agg(F.max("n").alias("n"), F.max("failed").alias("failed"))



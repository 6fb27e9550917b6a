"""The correction loop: landed records, a bounded number of files a batch, into the store of clean calls."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..sources import tables
from ..sources.store import CleanStore


def correction_loop(
    store: CleanStore, records: DataFrame, checkpoint: str, *, now: Callable[[], float] = time.time, days: int | None = 3, pointer: Sequence[str] = (), every: str | None = None,
    quarantine: str | None = None,
) -> StreamingQuery:
    """Start correcting a stream of raw records. every: a trigger's interval; None: all that is there now, then stop.

    Spark gives a batch that failed once more under the same number with the same files, and the store applies a number
    once. days: timeout of open calls, closed after each batch; None: never. quarantine: records are lines of files, as
    `tables.stream_lines` gives them, and the broken ones of each batch go there.
    """

    def step(batch: DataFrame, number: int) -> None:
        if quarantine is not None:
            batch, broken = tables.parsed_lines(batch)
            broken.write.mode("overwrite").parquet(f"{quarantine}/batch={number}")
        store.apply(batch, number, now(), pointer)
        if days is not None:
            store.expire(number, now(), days)

    writer = records.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)).start()

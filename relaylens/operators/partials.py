"""Mergeable partial aggregates by day, kept so that new records only add and no old record is read again.

A batch appends one row a key and day; a repeated batch replaces its own rows. The whole, or any span of days, comes from
the partials by one more aggregation. Files hold spans of days in order, so that a filter on days skips the others by
their statistics.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expr as X
from . import network, report


@dataclass(frozen=True)
class DailyPartials:
    """keys: what a row is for; sums, least, greatest: its columns that add up or of which the smallest or largest counts."""

    spark: SparkSession
    path: str
    keys: Sequence[str]
    sums: Sequence[str]
    least: Sequence[str] = ()
    greatest: Sequence[str] = ()

    def _merged(self, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        made = [f(c).alias(c) for f, names in ((F.sum, self.sums), (F.min, self.least), (F.max, self.greatest)) for c in names]
        return rows.groupBy(*keys).agg(*made)

    def add(self, rows: DataFrame, batch: int, day: str = "day") -> None:
        """Add partials (keys, day and columns) of a batch; rows of the same key and day are merged first."""
        own = self._merged(rows.withColumnRenamed(day, "day"), [*self.keys, "day"])
        own.repartitionByRange("day").sortWithinPartitions("day").write.mode("overwrite").parquet(f"{self.path}/batch={batch}")

    def total(self, first: str | None = None, last: str | None = None) -> DataFrame:
        """One row a key over all days, or over those from first to last (yyyy-MM-dd), both counting."""
        rows = self.spark.read.option("basePath", self.path).parquet(self.path)
        if first is not None:
            rows = rows.where(F.col("day") >= F.lit(first).cast("date"))
        if last is not None:
            rows = rows.where(F.col("day") <= F.lit(last).cast("date"))
        return self._merged(rows, self.keys)


def edge_partials(spark: SparkSession, path: str) -> DailyPartials:
    return DailyPartials(spark, path, network.EDGE, ["n"])


def edges_by_day(calls: DataFrame, time: str = "requestInTs") -> DataFrame:
    return calls.na.fill("", network.EDGE).groupBy(*network.EDGE, X.to_day(F.col(time)).alias("day")).agg(F.count(F.lit(1)).alias("n"))


def edges_of(partials: DailyPartials, first: str | None = None, last: str | None = None) -> DataFrame:
    """`network.edges` from partials."""
    return partials.total(first, last).withColumn("metaservice", F.col("serviceCode").isin(*network.META_SERVICES).cast("int"))


_VALUES = ("duration", "request", "response")
_REPORT_KEYS = ["subsystem", "role", "key1", "key2"]


def report_partials(spark: SparkSession, path: str) -> DailyPartials:
    sums = ["succeeded", "failed", *[f"{k}_{v}" for k in ("sum", "n") for v in _VALUES]]
    return DailyPartials(spark, path, _REPORT_KEYS, sums, [f"min_{v}" for v in _VALUES], [f"max_{v}" for v in _VALUES])


def report_by_day(calls: DataFrame, time: str = "requestInTs") -> DataFrame:
    """What report rows are merged from: counts, sums and bounds of each role, pair of keys and day."""
    first, second = report.role_keys()
    ok, values = report.measures()
    made = [f(F.when(ok, v)).alias(f"{n}_{k}") for k, v in values.items() for n, f in (("min", F.min), ("max", F.max), ("sum", F.sum), ("n", F.count))]
    rows = report.with_roles(calls).groupBy("subsystem", "role", first.alias("key1"), second.alias("key2"), X.to_day(F.col(time)).alias("day"))
    return rows.agg(F.count_if(ok).alias("succeeded"), F.count_if(~ok).alias("failed"), *made)


def report_of(partials: DailyPartials, first: str | None = None, last: str | None = None) -> DataFrame:
    """`report.report_rows` from partials."""
    rows = partials.total(first, last)
    means = {f"mean_{v}": F.try_divide(F.col(f"sum_{v}").cast("double"), F.col(f"n_{v}")) for v in _VALUES}
    return rows.withColumns(means).drop("sum_request", "n_request", "sum_response", "n_response")

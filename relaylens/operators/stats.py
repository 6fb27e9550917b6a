"""Usage statistics: calendar windows in one scan, services, members."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def calendar_windows(now: dt.datetime) -> dict[str, tuple[int, int]]:
    """Half-open windows in epoch milliseconds (UTC): previous and current year and month, today."""
    day = dt.datetime(now.year, now.month, now.day)
    month = day.replace(day=1)
    before = (month - dt.timedelta(days=1)).replace(day=1)
    after = (month + dt.timedelta(days=32)).replace(day=1)
    last = (now - dt.timedelta(days=365)).year
    ms = lambda d: int(d.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    year = lambda y: (ms(dt.datetime(y, 1, 1)), ms(dt.datetime(y + 1, 1, 1)))
    return {"previous_year": year(last), "current_year": year(now.year), "previous_month": (ms(before), ms(month)), "current_month": (ms(month), ms(after)), "today": (ms(day), ms(day + dt.timedelta(days=1)))}


def _within(now: dt.datetime, time: str) -> dict[str, Column]:
    t = F.col(time)
    return {name: F.coalesce((t >= a) & (t < b), F.lit(False)) for name, (a, b) in calendar_windows(now).items()}


def calendar_counts(calls: DataFrame, now: dt.datetime, time: str = "requestInTs", key: str | None = None) -> DataFrame:
    """One row: calls in total and in each window; with key, distinct keys.

    Keys are told apart once: a row a key says in which windows it occurs, and the rows are counted.
    """
    windows = _within(now, time)
    if key is not None:
        calls = calls.where(F.col(key).isNotNull()).groupBy(key).agg(*[F.bool_or(c).alias(n) for n, c in windows.items()])
        windows = {n: F.col(n) for n in windows}
    return calls.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(c).alias(n) for n, c in windows.items()])


def service_calendar(calls: DataFrame, now: dt.datetime, services: Sequence[str], column: str = "serviceSubsystemCode", time: str = "requestInTs", key: str = "_id") -> DataFrame:
    """A row for each of the given services: distinct calls in total and in each calendar window, 0 where there are none."""
    codes = list(dict.fromkeys(services))
    wanted = calls.sparkSession.createDataFrame([(s,) for s in codes], f"{column} string")
    windows = _within(now, time)
    mine = calls.where(F.col(column).isin(*codes) if codes else F.lit(False)).where(F.col(key).isNotNull())
    once = mine.groupBy(column, key).agg(*[F.bool_or(c).alias(n) for n, c in windows.items()])
    counted = once.groupBy(column).agg(F.count(F.lit(1)).alias("total"), *[F.count_if(n).alias(n) for n in windows])
    return wanted.join(counted, column, "left").fillna(0)


def top_services(calls: DataFrame, column: str = "serviceSubsystemCode", n: int | None = 5) -> DataFrame:
    """Services with most calls, listed by name; null or empty names don't count. n None or 0: all."""
    counts = calls.where(F.coalesce(F.col(column), F.lit("")) != "").groupBy(F.col(column).alias("service")).agg(F.count("*").alias("n_calls"))
    return (counts.orderBy(F.desc("n_calls"), "service").limit(n) if n else counts).orderBy("service")


def member_counts(classes: DataFrame, members: DataFrame) -> DataFrame:
    """Distinct members of each configured class, compared without case; classes without members count 0."""
    m = members.select(F.lower("member_class").alias("k"), "member_code").distinct()
    return classes.join(m, F.lower(classes["member_class"]) == m["k"], "left").groupBy("member_class").agg(F.count_distinct("member_code").alias("n_members"))


def append_snapshot(statistics: DataFrame, path: str, now: dt.datetime) -> None:
    """Append rows of statistics as one JSON document each, all under the time of the snapshot. Nothing older is changed.

    Nulls are written as well, so that a document always has all its fields.
    """
    document = F.to_json(F.struct(*statistics.columns), {"ignoreNullFields": "false"})
    statistics.select(F.lit(now).alias("update_time"), document.alias("statistics")).write.mode("append").parquet(path)


def latest(snapshots: DataFrame, time: str = "update_time") -> DataFrame:
    """Rows of the newest snapshot."""
    return snapshots.where(F.col(time) == snapshots.agg(F.max(time)).scalar())


def latest_statistics(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """update_time and the statistics of the newest snapshot, by the given schema; fields that it hasn't are null."""
    return latest(spark.read.parquet(path)).select("update_time", F.from_json("statistics", schema).alias("s")).select("update_time", "s.*")

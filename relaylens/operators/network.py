"""Who calls whom: edges with counts, names and labels, and the largest of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

EDGE = ["clientMemberCode", "clientSubsystemCode", "serviceMemberCode", "serviceSubsystemCode", "serviceCode"]
# Services that describe services. Networks were drawn before there was getOpenAPI, which reports know.
META_SERVICES = ("getWsdl", "listMethods", "allowedMethods", "getSecurityServerMetrics", "getSecurityServerOperationalData", "getSecurityServerHealthData")


def recent(calls: DataFrame, interval: int, buffer: int, date: str = "requestInDate") -> DataFrame:
    """Succeeded calls of `interval` days that end `buffer` days before the latest date."""
    last = calls.agg(F.max(date)).scalar()
    return calls.where("succeeded").where((F.col(date) >= F.date_sub(last, interval + buffer)) & (F.col(date) <= F.date_sub(last, buffer)))


def edges(calls: DataFrame, meta: Sequence[str] = META_SERVICES) -> DataFrame:
    """Calls of each edge; null codes count as empty."""
    return calls.na.fill("", EDGE).groupBy(*EDGE).agg(F.count("*").alias("n")).withColumn("metaservice", F.col("serviceCode").isin(*meta).cast("int"))


def named(edges_: DataFrame, members: DataFrame) -> DataFrame:
    """Edges with the names of both members, the code where a name is missing, and labels of nodes.

    members (member_code, member_name) is broadcast only below Spark's threshold. A code of several names gives a row each.
    """
    out = edges_
    for side in ("client", "service"):
        m = members.select(F.col("member_code").alias(f"__{side}"), F.col("member_name").alias(f"{side}Name"))
        code = F.col(f"{side}MemberCode")
        out = out.join(m, code == F.col(f"__{side}"), "left").withColumn(f"{side}Name", F.coalesce(f"{side}Name", code)).drop(f"__{side}")
        out = out.withColumn(f"{side}Label", F.concat_ws("\n", f"{side}Name", f"{side}SubsystemCode"))
    return out


def of_member(edges_: DataFrame, member: str, with_meta: bool = True) -> DataFrame:
    out = edges_.where((F.col("clientMemberCode") == member) | (F.col("serviceMemberCode") == member))
    return out if with_meta else out.where("metaservice = 0")


def largest(edges_: DataFrame, by: Sequence[str], n: int) -> DataFrame:
    """Sums of each pair `by`, those whose rank by size is at most n (ties stay together), with log10(sum + 1).

    Sums are one row a pair; only sums as large as the n-th are kept, so nothing is ordered in one task.
    """
    total = edges_.groupBy(*by).agg(F.sum("n").alias("nn"))
    least = total.select("nn").orderBy(F.desc("nn")).limit(n).agg(F.min("nn").alias("__least"))
    return total.join(F.broadcast(least), F.col("nn") >= F.col("__least")).drop("__least").withColumn("weight", F.log10(F.col("nn") + 1))


def members(edges_: DataFrame) -> DataFrame:
    """All member codes of either side in order."""
    return edges_.select(F.col("clientMemberCode").alias("member")).union(edges_.select("serviceMemberCode")).distinct().orderBy("member")


def top_ties(df: DataFrame, by: Sequence[str], value: str, n: int) -> DataFrame:
    """Rows of each group whose rank by value is at most n, ties kept."""
    return df.withColumn("rank", F.rank().over(Window.partitionBy(*by).orderBy(F.desc(value)))).where(F.col("rank") <= n)

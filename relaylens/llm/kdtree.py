"""Sharding by k-d tree: split nodes at weighted medians until the leaves reach the target bytes.

A node is split along its widest dimension (each dimension scaled by its range over all rows) at the weighted median
of (value, key), so that rows of equal value, even a third of all, divide by their key. Medians are exact and found for
all nodes of a level together: rows are summed into bins between two bounds, the bin in which the median lies becomes
the new bounds, until it holds one value. A job brings the driver one row a node; nodes are bounded by the number of
leaves, total bytes over target bytes.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, written

BINS = 2048


def kd_shards(rows: DataFrame, dims: list[str], weight: str, key: str, target: int) -> DataFrame:
    """rows with an int column `shard`: leaf numbers from 0 in tree order, each leaf of about `target` weight at most.

    A node of weight w becomes ceil(w / target) leaves, divided as evenly as whole leaves allow. dims: numeric columns,
    null counts as less than all. key: a long that orders rows of equal value; null counts as less than all; rows that
    are equal in value and key stay together. Without rows there are no shards. `shard`, `__node`, `__dim*` and `__key`
    of rows are replaced.
    """
    spark = rows.sparkSession
    names = [f"__dim{i}" for i in range(len(dims))]
    spread = rows.agg(F.sum(weight).alias("w"), *[f(F.col(d).cast("double")).alias(f"{n}_{i}") for i, d in enumerate(dims) for n, f in (("lo", F.min), ("hi", F.max))]).first()
    total = int(spread["w"] or 0)
    if not total:
        return rows.withColumn("shard", F.lit(0))
    scaled = {}
    for i, d in enumerate(dims):
        lo, hi = spread[f"lo_{i}"], spread[f"hi_{i}"]
        width = (hi - lo) if lo is not None and hi > lo else 1.0
        scaled[names[i]] = F.coalesce((F.col(d).cast("double") - F.lit(lo or 0.0)) / F.lit(width), F.lit(-0.01))
    rows = rows.withColumns({**scaled, "__key": F.coalesce(F.col(key).cast("long"), F.lit(-(2**63))), "__node": F.lit(0)})
    nodes = {0: (0, max(1, math.ceil(total / target)))}  # node: first leaf, leaves
    while any(n > 1 for _, n in nodes.values()):
        rows = written(rows)
        open_ = {k: v for k, v in nodes.items() if v[1] > 1}
        mark = _params(spark, [(k,) for k in open_], "__n int")
        stats = rows.join(F.broadcast(mark), F.col("__node") == F.col("__n"), "left_semi").groupBy("__node").agg(F.sum(weight).alias("w"), *[f(c).alias(f"{n}{c}") for c in names for n, f in (("lo", F.min), ("hi", F.max))]).collect()
        cuts = {}
        for r in stats:
            wide = max(range(len(names)), key=lambda i: (r[f"hi{names[i]}"] - r[f"lo{names[i]}"], -i))
            n = open_[r["__node"]][1]
            cuts[r["__node"]] = {"dim": wide, "goal": int(r["w"]) * (n // 2) / n, "lo": r[f"lo{names[wide]}"], "hi": r[f"hi{names[wide]}"]}
        for k in open_.keys() - cuts.keys():  # no rows here: equal rows, which stay together, went to the other side
            nodes[k] = (nodes[k][0], 1)
        if not cuts:
            break
        chosen = _params(spark, [(k, c["dim"]) for k, c in cuts.items()], "__n int, __d int")
        value = F.get(F.array(*names), F.col("__d"))
        part = rows.join(F.broadcast(chosen), F.col("__node") == F.col("__n")).select("__node", value.alias("v"), "__key", F.col(weight).cast("long").alias("w"))
        at = _medians(part, "v", {k: (c["lo"], c["hi"], c["goal"]) for k, c in cuts.items()}, "double")
        ties = part.join(F.broadcast(_params(spark, [(k, a["value"]) for k, a in at.items()], "__n int, __v double")), (F.col("__node") == F.col("__n")) & (F.col("v") == F.col("__v")))
        ends = {r["__node"]: (r["lo"], r["hi"]) for r in ties.groupBy("__node").agg(F.min("__key").alias("lo"), F.max("__key").alias("hi")).collect()}
        keys = _medians(ties.select("__node", F.col("__key").alias("v"), "w"), "v", {k: (*ends[k], a["goal"]) for k, a in at.items()}, "decimal(20,0)")
        cut = []
        for k in cuts:
            first, n = nodes.pop(k)
            left, right = 2 * k + 1, 2 * k + 2
            nodes[left], nodes[right] = (first, n // 2), (first + n // 2, n - n // 2)
            # The row at the median goes to the side that it makes less uneven.
            own = keys[k]
            cut.append((k, cuts[k]["dim"], at[k]["value"], int(own["value"]) - (own["goal"] < own["weight"] / 2), left, right))
        plan = _params(spark, cut, "__n int, __d int, __v double, __k decimal(20,0), __left int, __right int")
        value = F.get(F.array(*names), F.col("__d"))
        is_left = (value < F.col("__v")) | ((value == F.col("__v")) & (F.col("__key").cast("decimal(20,0)") <= F.col("__k")))
        rows = rows.join(F.broadcast(plan), F.col("__node") == F.col("__n"), "left")
        rows = rows.withColumn("__node", F.when(F.col("__n").isNull(), F.col("__node")).when(is_left, F.col("__left")).otherwise(F.col("__right"))).drop("__n", "__d", "__v", "__k", "__left", "__right")
    leaves = _params(spark, [(k, first) for k, (first, _) in nodes.items()], "__n int, shard int")
    return rows.drop("shard").join(F.broadcast(leaves), F.col("__node") == F.col("__n")).drop(*names, "__key", "__node", "__n")


def _params(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A row a node: at most as many as leaves, so that these tables may be broadcast."""
    from decimal import Decimal

    fixed = [tuple(Decimal(x) if "decimal" in f else x for x, f in zip(r, schema.replace("(20,0)", "").split(", "))) for r in rows]
    return spark.createDataFrame(fixed, schema)


def _medians(rows: DataFrame, value: str, goals: dict[int, tuple], kind: str) -> dict[int, dict]:
    """For each node the value at which the summed weight reaches the goal, the weight there and what of the goal is left.

    rows: __node, value, w. goals: node -> (least value, greatest value, goal).
    """
    spark = rows.sparkSession
    exact = kind != "double"
    todo = {k: {"lo": lo, "hi": hi, "goal": goal} for k, (lo, hi, goal) in goals.items()}
    done: dict[int, dict] = {}
    order = Window.partitionBy("__node").orderBy("bin")
    while todo:
        at = _params(spark, [(k, t["lo"], t["hi"], float(t["goal"])) for k, t in todo.items()], f"__n int, lo {kind}, hi {kind}, goal double")
        v = F.col(value).cast(kind)
        inside = rows.join(F.broadcast(at), F.col("__node") == F.col("__n")).where((v >= F.col("lo")) & (v <= F.col("hi")))
        width = (F.col("hi") - F.col("lo")).cast("double") + (1.0 if exact else 0.0)
        share = F.when(width > 0, (v - F.col("lo")).cast("double") / width).otherwise(F.lit(0.0))
        bins = inside.select("__node", "goal", v.alias("v"), "w", F.least(F.floor(share * BINS), F.lit(BINS - 1)).cast("int").alias("bin"))
        bins = bins.groupBy("__node", "bin").agg(F.sum("w").alias("w"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.first("goal").alias("goal"))
        # At most BINS rows a node are ordered here.
        summed = bins.withColumn("upto", F.sum("w").over(order)).withColumn("n", F.lead("bin").over(order))
        hit = summed.where("upto - w < goal or upto = w").where("upto >= goal or n is null").groupBy("__node").agg(F.min(F.struct("bin", "lo", "hi", "w", F.expr("goal - (upto - w)").alias("goal"))).alias("x")).select("__node", "x.*")
        for r in hit.collect():
            k = r["__node"]
            if r["lo"] == r["hi"]:
                done[k] = {"value": r["lo"], "goal": float(r["goal"]), "weight": float(r["w"])}
                todo.pop(k)
            else:
                todo[k] = {"lo": r["lo"], "hi": r["hi"], "goal": float(r["goal"])}
    return done


def with_slots(rows: DataFrame, by: str, order: list[str]) -> DataFrame:
    """rows with `slot`: 0, 1, 2 … within each `by`, in the order given, without bringing a shard into one task.

    Rows are range-partitioned by (by, order); a small table, a row for each range and shard, gives the offsets.
    """
    spark = rows.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(ranges, by, *order).sortWithinPartitions(by, *order)
    rows = written(rows.withColumn("__at", F.monotonically_increasing_id()))
    range_ = F.shiftright("__at", 33)
    counts = rows.groupBy(F.col(by).alias("__by"), range_.alias("__range")).agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    before = Window.partitionBy("__by").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    # At most a row for each range and one more for each shard.
    out = rows.join(F.broadcast(counts), (F.col(by) == F.col("__by")) & (range_ == F.col("__range")))
    return out.withColumn("slot", (F.col("__at") - F.col("__first") + F.col("__before")).cast("long")).drop("__at", "__by", "__range", "__first", "__before")


def document_metadata(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and the dimensions of each document. A null text has size 1."""
    text = F.coalesce("text", F.lit(""))
    size = (F.octet_length(text) + 1).cast("long")
    spread = lambda c: F.crc32(F.coalesce(F.col(c).cast("string"), F.lit("")).cast("binary")).cast("double")
    return docs.select("doc_id", size.alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.log2(size.cast("double")).alias("log_size"), spread("lang").alias("lang_code"), spread("source").alias("source_code"))


def op2_kd_shards(spark: SparkSession, sf_dir: str, shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document; the law is `bytes`.

    Rows of equal dimensions divide by their number in the table, so that rows that are in it many times do so too.
    """
    rows = written(document_metadata(table(spark, sf_dir, "documents")).withColumn("row", F.monotonically_increasing_id()))
    total = int(rows.agg(F.sum("size")).first()[0] or 0)
    sharded = kd_shards(rows, ["log_size", "lang_code", "source_code"], "size", "row", max(1, math.ceil(total / shards)))
    out = with_slots(sharded.select("doc_id", "size", "text_crc32", "shard"), "shard", ["doc_id", "text_crc32"])
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))

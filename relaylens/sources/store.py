"""The table of clean calls, corrected batch by batch: a batch rewrites only the folders whose calls it changes.

Orphans with a request id lie in calls/part=<hash of the id>/batch=<number of the batch that saw it first>, pairs in
pairs/part=/batch=<number of the batch that made it one>, which no later batch changes. A batch reads ids of the parts
that its own ids fall in, adds folders of its own to these, and rewrites earlier folders only if they hold an orphan
whose partner has come. What it writes is staged first, then its folders are moved into place. A batch that failed is
simply applied again under its number: before its counters are written, which come last, it starts anew, after
that only putting in place is repeated, and once it is noted as done nothing happens. Records without request id
(lost/batch=), rejected ones (rejected/batch=), counters and pointers lie in folders of their batch.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import correct
from ..plans.shared import dealt, open_writers


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the path is there, in whatever file system it lies."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


@dataclass(frozen=True)
class CleanStore:
    """parts: number of parts by hash, which also bounds what reaches the driver of a batch. It can't change later."""

    spark: SparkSession
    path: str
    parts: int = 64

    def _at(self, kind: str, batch: int | None = None) -> str:
        return f"{self.path}/{kind}" + ("" if batch is None else f"/batch={batch}")

    def _whole(self, path: str) -> bool:
        return exists(self.spark, f"{path}/_SUCCESS")

    def _placed(self, path: str) -> DataFrame | None:
        """Calls at a path by the table's schema, which the first batch has set; None before there is any."""
        if not (self._whole(self._at("schema")) and exists(self.spark, path)):
            return None
        return self.spark.read.schema(self.spark.read.parquet(self._at("schema")).schema).parquet(path)

    def _open(self) -> DataFrame | None:
        """Calls that still lack a side."""
        return self._placed(self._at("calls"))

    def _calls(self) -> DataFrame | None:
        orphans, pairs = self._open(), self._placed(self._at("pairs"))
        return orphans if orphans is None or pairs is None else orphans.unionByName(pairs)

    def read(self) -> DataFrame:
        """All clean calls, those without request id among them."""
        calls = self._calls()
        if calls is None:
            raise ValueError(f"no batch was corrected in {self.path}")
        return calls.drop("part", "has_client", "has_producer").unionByName(self.spark.read.parquet(self._at("lost"))).drop("batch")

    def rejected(self) -> DataFrame:
        """Duplicates and invalid records with their kind and batch."""
        return self.spark.read.parquet(self._at("rejected"))

    def counters(self) -> DataFrame:
        """A row for each batch: records processed, duplicates, faulty and invalid ones, calls made and completed."""
        return self.spark.read.parquet(self._at("counters"))

    def pointers(self) -> DataFrame:
        """The log of positions by key and batch, for `tables.current`."""
        return self.spark.read.parquet(self._at("pointers"))

    def is_done(self, batch: int) -> bool:
        return self._whole(self._at("done", batch))

    def apply(self, raw: DataFrame, batch: int, now: float, pointer: Sequence[str] = (), position: str = "requestInTs") -> None:
        """Correct a batch of raw records into the table. pointer: columns by which its last position is noted."""
        if self.is_done(batch):
            return
        stage = self._at("staged", batch)
        if not self._whole(self._at("counters", batch)):
            self._stage(raw, batch, now, stage, list(pointer), position)
        self._publish(stage)
        self.spark.range(0).coalesce(1).write.mode("overwrite").parquet(self._at("done", batch))

    def expire(self, batch: int, now: float, days: int = 3) -> None:
        """Close open calls older than the timeout; rewrites the folders that hold such."""
        calls = self._open()
        if calls is None or self._whole(self._at("expired", batch)):
            return
        stage = self._at("staged-expiry", batch)
        if not self._whole(stage):
            late = calls.where(correct.timed_out(calls, now, days)).select("part", "batch").distinct()
            self._save(correct.expire(calls.join(F.broadcast(late), ["part", "batch"], "left_semi"), now, days), stage)  # a row a folder at most
        self._publish(stage)
        self.spark.range(0).coalesce(1).write.mode("overwrite").parquet(self._at("expired", batch))

    def _part(self) -> Column:
        """By the hash that deals rows to tasks, so that a task of `_buckets` holds one part only."""
        return F.pmod(F.hash("xRequestId"), F.lit(self.parts))

    def _buckets(self) -> int:
        """A multiple of the parts, at least as many as Spark's shuffles have."""
        return -(-int(self.spark.conf.get("spark.sql.shuffle.partitions")) // self.parts) * self.parts

    def _save(self, calls: DataFrame, stage: str) -> None:
        """calls come dealt by request id or as they lie in their folders, so a task has few folders to write to."""
        calls = calls.withColumn("kind", F.when(F.col("has_client") & F.col("has_producer"), "pairs").otherwise("calls"))
        with open_writers(calls.sparkSession, 256):
            calls.write.mode("overwrite").partitionBy("kind", "part", "batch").option("compression", "zstd").parquet(stage)

    def _publish(self, stage: str) -> None:
        """Move staged folders into the place of those of their name. What a failed move has left in the stage is moved next time."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        fs = path(stage).getFileSystem(self.spark._jsc.hadoopConfiguration())
        for kind in ("calls", "pairs"):
            fs.mkdirs(path(self._at(kind)))
            for folder in fs.globStatus(path(f"{stage}/kind={kind}/part=*/batch=*")):
                at = folder.getPath()
                to = path(f"{self._at(kind)}/{at.getParent().getName()}/{at.getName()}")
                fs.mkdirs(to.getParent())
                fs.delete(to, True)
                if not fs.rename(at, to):
                    raise OSError(f"{at} could not be moved to {to}")

    def _emptied(self, stage: str, folders: DataFrame) -> None:
        """Empty folders in the stage for those whose orphans have all become pairs, so that theirs are replaced as well."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        fs = path(stage).getFileSystem(self.spark._jsc.hadoopConfiguration())
        for r in folders.collect():  # at most self.parts a batch that has orphans
            fs.mkdirs(path(f"{stage}/kind=calls/part={r['part']}/batch={r['batch']}"))

    def _same_columns(self, raw: DataFrame) -> DataFrame:
        """raw with the columns that the table's records have: missing ones null, others left out."""
        calls = self._calls()
        if calls is None:
            return raw
        return raw.select(*[(F.col(f.name) if f.name in raw.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in calls.schema["client"].dataType])

    def _stage(self, raw: DataFrame, batch: int, now: float, stage: str, pointer: list[str], position: str) -> None:
        seen = Observation()
        counted = [F.count_if(F.col("fault") == k).alias(k) for k in ("faulty", "invalid")]
        # The only time that whole records move: ranks, pairs and partners are then found bucket by bucket.
        records = dealt(correct.keyed(self._same_columns(raw)).observe(seen, F.count(F.lit(1)).alias("processed"), *counted), self._buckets(), "request")
        faults = lambda kind: correct.normalised(records.where(F.col("fault") == kind).drop("fault", "request"))
        sound = correct.placed(records)
        if pointer:
            ends = records.groupBy(*pointer).agg(F.max(position).cast("double").alias("position"))
            ends.write.mode("overwrite").parquet(self._at("pointers", batch))
        correct.lost_calls(faults("faulty"), now).write.mode("overwrite").parquet(self._at("lost", batch))
        first, calls, grew = correct.normalised(sound.where("place = 1").drop("place")), self._calls(), None
        fresh, ranked_out = correct.paired(first), sound.where("place > 1")
        if calls is None:
            out = correct.derived(fresh, now).withColumns({"since": F.lit(batch), "grew": F.lit(None).cast("boolean")})
        else:
            has = lambda side, name: F.max(correct.party() == side).alias(name)
            sides = records.where("fault is null").groupBy(F.col("request").alias("xRequestId")).agg(has("client", "new_c"), has("producer", "new_p"))
            touched = [r["part"] for r in sides.select(self._part().alias("part")).distinct().collect()]  # at most self.parts
            old = calls.where(F.col("part").isin(touched)) if touched else calls.limit(0)
            met = dealt(old.select("part", "xRequestId", "batch", "has_client", "has_producer").join(sides, "xRequestId"), self._buckets(), "xRequestId")
            grew = met.where("(new_c and not has_client) or (new_p and not has_producer)").select("part", "batch").distinct()
            held = met.select("xRequestId", "has_client", "has_producer")
            holds = ((correct.party() == "client") & F.col("has_client")) | ((correct.party() == "producer") & F.col("has_producer"))
            ranked_out = sound.join(held, "xRequestId", "left").where((F.col("place") > 1) | holds).select(*sound.columns)
            # Orphans alone are moved to their partners; of all the others it is enough to know that they are there.
            orphans = self._open().join(F.broadcast(grew), ["part", "batch"], "left_semi")  # a row a folder at most; prunes the scan
            orphans = orphans.select("xRequestId", F.col("batch").alias("since"), F.struct("client", "producer", "correctorTime", "correctorStatus").alias("old"))
            new = fresh.select("xRequestId", *[F.col(k).cast(calls.schema[k].dataType).alias(f"new_{k}") for k in ("client", "producer")])
            new = new.join(held.select("xRequestId", F.lit(True).alias("known")), "xRequestId", "left")
            both = new.join(orphans, "xRequestId", "full_outer").where("known is null or since is not null")
            out = correct.completed(both, now, ["since"])
            out = out.withColumns({"grew": F.when(F.col("since").isNotNull(), F.col("grew")), "since": F.coalesce("since", F.lit(batch))})
        turned_down = Observation()
        rejected = correct.normalised(ranked_out.drop("place")).withColumn("kind", F.lit("duplicate")).unionByName(faults("invalid").withColumn("kind", F.lit("invalid")))
        rejected = rejected.observe(turned_down, F.count_if(F.col("kind") == "duplicate").alias("duplicates"))
        rejected.write.mode("overwrite").option("compression", "zstd").parquet(self._at("rejected", batch))
        out = out.withColumns({"has_client": F.col("client").isNotNull(), "has_producer": F.col("producer").isNotNull(), "part": self._part()})
        out = out.withColumn("batch", F.when(F.col("has_client") & F.col("has_producer"), F.lit(batch)).otherwise(F.col("since"))).drop("since")
        if calls is None:
            self.spark.createDataFrame([], out.drop("grew").schema).coalesce(1).write.mode("overwrite").parquet(self._at("schema"))
        made = Observation()
        self._save(out.observe(made, F.count_if(F.col("grew").isNull()).alias("made"), F.count_if(F.coalesce("grew", F.lit(False))).alias("completed")).drop("grew"), stage)
        if grew is not None:
            self._emptied(stage, grew)
        n = seen.get | turned_down.get | made.get
        names = ["processed", "duplicates", "faulty", "invalid", "made", "completed"]
        self.spark.createDataFrame([[n.get(c, 0) for c in names]], ", ".join(f"{c} long" for c in names)).coalesce(1).write.mode("overwrite").parquet(self._at("counters", batch))

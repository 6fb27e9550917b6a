"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@cache
def _own_folder() -> str:
    return "file://" + tempfile.mkdtemp(prefix="relaylens-")


def shared_folder(spark: SparkSession) -> str:
    """A new path in the folder that the driver and all executors share (spark.checkpoint.dir).

    Only where that setting is missing, as in local tests, a temporary folder of this machine is used.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or _own_folder()
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage, and a lost executor costs nothing before it."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_batches(df: DataFrame, rows: int = 1_000) -> DataFrame:
    """df, after limiting the rows that Spark hands a Python worker at once: texts are long and workers' memory is small."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    return df


@contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Within: Spark hands a Python worker that many rows at once. For jobs that end within, since results are evaluated later."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Rows that no model may learn from: crc32 of the id as text, modulo 3, is 1."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 3 == 1, F.lit(False))


class WordHashes(dict):
    """word (bytes) -> 64-bit hash, remembered for up to `most` words of a Python worker."""

    most = 150_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose bits all depend on all input bits."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n consecutive words, in order; empty where there are fewer words."""
    count = len(words) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    h = np.zeros(count, np.uint64)
    for i in range(n):
        h = (h + words[i : i + count]) * _ODD
        h ^= h >> np.uint64(32)
    return mix(h)


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, component) with the smallest id that links reach.

    nodes: id; edges: src, dst between ids. Each round every node takes the smallest label of itself and its
    neighbours (a pre-aggregated min), then the label of its label (pointer jumping), until nothing changes.
    Rounds are cut through written tables; only one count a round reaches the driver.
    """
    both = written(edges.select("src", "dst").union(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).where("src <> dst").distinct())
    labels = written(both.groupBy(F.col("src").alias("id")).agg(F.least(F.min("dst"), F.first("src")).alias("label")))
    while True:
        near = both.join(labels.select(F.col("id").alias("dst"), "label"), "dst").groupBy(F.col("src").alias("id")).agg(F.min("label").alias("near"))
        lower = labels.join(near, "id").select("id", "label", F.least("label", "near").alias("low"))
        step = written(lower)
        jump = step.join(step.select(F.col("id").alias("low"), F.col("low").alias("lower")), "low", "left")
        new = written(jump.select("id", F.coalesce(F.least("low", "lower"), "low").alias("label"), (F.col("label") != F.coalesce(F.least("low", "lower"), "low")).alias("moved")))
        labels = new.select("id", "label")
        if not new.where("moved").limit(1).count():
            return nodes.select("id").join(labels, "id", "left").select("id", F.coalesce("label", "id").alias("component"))


#: Ids of 8 bytes each that may be broadcast at once.
BROADCAST_IDS = 500_000


def without(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is none of ids (rows with a null key stay). ids are broadcast up to BROADCAST_IDS, else shuffled."""
    ids = written(ids.where(F.col(key).isNotNull()).distinct())
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return rows.join(F.broadcast(ids) if few else ids, key, "left_anti").select(*rows.columns)

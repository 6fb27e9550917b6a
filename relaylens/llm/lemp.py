"""Hard-negative mining by exact inner-product search with coordinate pruning.

Vectors are cut into length buckets: runs of consecutive rows of one label by falling length. A bucket holds its vectors
as one matrix and, for each coordinate, the unit vectors' values in rising order. Anchors are packed into blocks, and each
block meets each bucket: once in search of positives, for the anchors of the bucket's label, then of negatives, for the
others. From the least score that still counts follows a least cosine in a bucket, and from that the range that a
candidate's value must lie in for each of the anchor's focus coordinates, its largest ones. Only rows within all ranges
are scored. The threshold rises while a block goes over the buckets of one deal; each deal gives its best rows, which a
window ranks.

Components are integers of at most 2^26 (larger ones count as that), so that scores are exact. Repeated rows count once,
rows without vec_id, which can't be named, and empty vectors take no part, and an anchor's own id is never its positive.
Vectors are only compared with those of the same number of components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import batch_rows, table, written

#: Rows of a length bucket, buckets that share a running threshold, anchors of a block.
BUCKET, DEAL, BLOCK = 2048, 8, 128
#: Coordinates of an anchor whose ranges are intersected.
FOCUS = 4
POSITIVES, NEGATIVES = 5, 10
#: Bounds of a negative's score in hundredths of its positive's.
LEAST, MOST = 30, 90
LARGEST = 1 << 26
_SLACK = 1e-5  # unit values are kept in single precision

_BUCKETS = "bucket string, dim int, label long, ids binary, vectors binary, lengths binary, rising binary, places binary"
_BLOCKS = "block string, dim int, ids binary, labels binary, vectors binary"
_ANY = (-(2**63), 2**63 - 1)


def usable(rows: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id, label, dim, v (integers floor(scale * x)) and length2 of the rows that take part, each once."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") > 0) & ~bad)
    cut = lambda x: F.floor(F.greatest(F.lit(-float(LARGEST)), F.least(F.lit(float(LARGEST)), x.cast("double") * scale)))
    out = whole.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.transform("embedding", cut).alias("v")).distinct()
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    return out.select("vec_id", "label", F.size("v").alias("dim"), "v", square.alias("length2"))


def shifted_labels(rows: DataFrame, every: int = 7, labels: int = 10) -> DataFrame:
    """Rows in which the label of each vec_id that `every` divides is the next one."""
    return rows.select("vec_id", F.when(F.col("vec_id") % every == 0, (F.col("label") + 1) % labels).otherwise(F.col("label")).alias("label"), "embedding")


def _bucket(rows: pd.DataFrame, name: str) -> tuple:
    v = np.array(rows["v"].tolist(), np.int64)
    length = np.sqrt((v.astype(np.float64) ** 2).sum(1))
    unit = (v / np.where(length > 0, length, 1)[:, None]).astype(np.float32).T
    places = np.argsort(unit, axis=1, kind="stable")
    rising = np.take_along_axis(unit, places, 1)
    first = rows.iloc[0]
    return (name, int(first["dim"]), int(first["label"]), rows["vec_id"].to_numpy(np.int64).tobytes(), v.astype(np.int32).tobytes(), length.tobytes(), np.ascontiguousarray(rising).tobytes(), places.astype(np.uint16).tobytes())


def length_buckets(rows: DataFrame, size: int = BUCKET) -> DataFrame:
    """Buckets of up to `size` rows of one label and number of components, by falling length.

    A range partitioning deals rows out by label, length and id, so that a common label goes to many tasks; each task
    makes a bucket of every `size` consecutive rows and holds no more than that and one Arrow batch.
    """
    order = [F.col("dim"), F.col("label"), F.col("length2").desc(), F.col("vec_id")]

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        count = 0
        for frame in frames:
            for _, run in frame.groupby(["dim", "label"], sort=False):
                if held and tuple(held[0].iloc[0][["dim", "label"]]) != tuple(run.iloc[0][["dim", "label"]]):
                    yield made(held)
                    held, count = [], 0
                while count + len(run) >= size:
                    head, run = run.iloc[: size - count], run.iloc[size - count :]
                    yield made([*held, head])
                    held, count = [], 0
                if len(run):
                    held.append(run)
                    count += len(run)
        if held:
            yield made(held)

    def made(parts: list[pd.DataFrame]) -> pd.DataFrame:
        rows = pd.concat(parts, ignore_index=True)
        return pd.DataFrame([_bucket(rows, "/".join(str(rows[c][0]) for c in ("dim", "label", "length2", "vec_id")))], columns=[c.split()[0] for c in _BUCKETS.split(", ")])

    return rows.select("vec_id", "label", "dim", "v", "length2").repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(cut, _BUCKETS)


def anchor_blocks(anchors: DataFrame, count: int, size: int = BLOCK) -> DataFrame:
    """Anchors packed into blocks of about `size`; count: how many anchors there are."""

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        v = np.array(rows["v"].tolist(), np.int64)
        packed = [rows[c].to_numpy(np.int64).tobytes() for c in ("vec_id", "label")]
        return pd.DataFrame([(f"{rows['dim'].iloc[0]}/{rows['part'].iloc[0]}", int(rows["dim"].iloc[0]), *packed, v.tobytes())], columns=[c.split()[0] for c in _BLOCKS.split(", ")])

    part = F.pmod(F.xxhash64("vec_id", "v"), F.lit(max(1, count // size))).alias("part")
    return anchors.select("vec_id", "label", "dim", "v", part).groupBy("dim", "part").applyInPandas(pack, _BLOCKS)


class Bucket:
    """A bucket as arrays."""

    def __init__(self, label: int, ids: bytes, vectors: bytes, lengths: bytes, rising: bytes, places: bytes, dim: int):
        self.label = label
        self.ids = np.frombuffer(ids, np.int64)
        self.vectors = np.frombuffer(vectors, np.int32).reshape(-1, dim).astype(np.int64)
        self.lengths = np.frombuffer(lengths, np.float64)
        self.rising = np.frombuffer(rising, np.float32).reshape(dim, -1)
        self.places = np.frombuffer(places, np.uint16).reshape(dim, -1)
        self.longest = float(self.lengths.max())
        self.largest = float(np.abs(self.vectors).max())
        self.doubles = self.vectors.astype(np.float64)

    def candidates(self, unit: np.ndarray, length: float, focus: np.ndarray, least: float) -> np.ndarray | None:
        """Places of rows that can reach the score `least`; None: all can.

        A row of cosine c or more to the anchor lies within the angle arccos(c) of it, so its angle to an axis differs from the
        anchor's angle to that axis by no more.
        """
        if least <= 0 or length == 0:
            return None
        cosine = least / (length * self.longest) if self.longest > 0 else 2.0
        if cosine > 1 + _SLACK:
            return np.empty(0, np.int64)
        wide, hits, used = np.arccos(min(1.0, cosine)), None, 0
        for f in focus:
            own = np.arccos(np.clip(unit[f], -1, 1))
            low, high = np.cos(min(np.pi, own + wide)) - _SLACK, np.cos(max(0.0, own - wide)) + _SLACK
            a, b = np.searchsorted(self.rising[f], low, "left"), np.searchsorted(self.rising[f], high, "right")
            if b - a == len(self.ids):
                continue
            if hits is None:
                hits = np.zeros(len(self.ids), np.uint8)
            hits[self.places[f, a:b]] += 1
            used += 1
        return None if hits is None else np.flatnonzero(hits == used)

    def scores(self, anchor: np.ndarray, at: np.ndarray | None) -> np.ndarray:
        """Exact inner products; in doubles where these hold all sums exactly."""
        exact = self.largest * float(np.abs(anchor).max()) * len(anchor) < 2**52
        v = self.doubles if exact else self.vectors
        return ((v if at is None else v[at]) @ anchor.astype(v.dtype)).astype(np.int64)


class Best:
    """The k highest scores so far, smaller ids first among equals."""

    def __init__(self, k: int):
        self.k, self.ids, self.scores = k, np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        if not len(ids):
            return
        ids, scores = np.concatenate([self.ids, ids]), np.concatenate([self.scores, scores])
        best = np.lexsort((ids, -scores))[: self.k]
        self.ids, self.scores = ids[best], scores[best]

    def least(self) -> int:
        """What a further row must score at least."""
        return int(self.scores[-1]) if len(self.ids) == self.k else _ANY[0]


class _Anchors:
    """A block's anchors and their targets (key, lower and upper bound of a score) with the best rows found for each."""

    def __init__(self, ids: bytes, labels: bytes, vectors: bytes, dim: int, k: int):
        self.ids, self.labels = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64)
        self.vectors = np.frombuffer(vectors, np.int64).reshape(-1, dim)
        self.lengths = np.sqrt((self.vectors.astype(np.float64) ** 2).sum(1))
        self.units = self.vectors / np.where(self.lengths > 0, self.lengths, 1)[:, None]
        self.focus = np.argsort(-np.abs(self.units), axis=1)[:, :FOCUS]
        self.k = k
        self.targets: list[list[tuple[tuple, int, int, Best]]] = [[] for _ in self.ids]

    def want(self, i: int, key: tuple, low: int, high: int) -> None:
        self.targets[i].append((key, low, high, Best(self.k)))

    def probe(self, bucket: Bucket, same: bool) -> None:
        for i, wanted in enumerate(self.targets):
            if not wanted or (self.labels[i] == bucket.label) != same:
                continue
            at = bucket.candidates(self.units[i], self.lengths[i], self.focus[i], min(max(low, best.least()) for _, low, _, best in wanted))
            scores, ids = bucket.scores(self.vectors[i], at), bucket.ids if at is None else bucket.ids[at]
            for _, low, high, best in wanted:
                fits = (scores >= max(low, best.least())) & (scores <= high)
                if same:
                    fits &= ids != self.ids[i]
                best.add(ids[fits], scores[fits])


def _pairs(blocks: DataFrame, buckets: DataFrame, deals: int) -> DataFrame:
    """Each block beside each bucket. A merge join puts the buckets of a deal that a block meets one after another."""
    left = blocks.withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit(deals - 1))))
    right = buckets.select(F.pmod(F.xxhash64("bucket"), F.lit(deals)).cast("int").alias("deal"), "dim", *[F.col(c).alias(f"b_{c}") for c in buckets.columns if c != "dim"])
    return left.join(right.hint("merge"), ["deal", "dim"])


def _probed(pairs: DataFrame, k: int, same: bool) -> DataFrame:
    """block, place of the anchor, anchor_id, target (number, id and score), found id and score: the best k of each deal."""
    names = ["block", "place", "anchor_id", "target", "target_id", "target_score", "id", "score"]

    def begun(row) -> _Anchors:
        anchors = _Anchors(row.ids, row.labels, row.vectors, row.dim, k)
        if same:
            for i in range(len(anchors.ids)):
                anchors.want(i, (0, 0, 0), *_ANY)
        else:
            for t in row.targets:
                score = int(t["target_score"])
                anchors.want(t["place"], (t["target"], t["target_id"], score), -(-LEAST * score // 100), MOST * score // 100)
        return anchors

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, anchors = None, None

        def told() -> pd.DataFrame:
            rows = [(now[0], i, int(anchors.ids[i]), *key, int(x), int(s)) for i, wanted in enumerate(anchors.targets) for key, _, _, best in wanted for x, s in zip(best.ids, best.scores)]
            return pd.DataFrame(rows, columns=names)

        for frame in frames:
            for row in frame.itertuples(index=False):
                if (row.block, row.deal) != now:
                    if now:
                        yield told()
                    now, anchors = (row.block, row.deal), begun(row)
                anchors.probe(Bucket(row.b_label, row.b_ids, row.b_vectors, row.b_lengths, row.b_rising, row.b_places, row.dim), same)
        if now:
            yield told()

    return pairs.mapInPandas(search, "block string, place int, anchor_id long, target int, target_id long, target_score long, id long, score long")


def _ranked(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, every: int = 100, scale: int = 256, bucket: int = BUCKET, block: int = BLOCK) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score, ties by smaller id.

    rows: vec_id, label, embedding. Anchors are the rows whose vec_id `every` divides; their positives the first POSITIVES
    others of the same label; their negatives, for each positive, the first NEGATIVES of other labels whose score lies
    between LEAST and MOST hundredths of the positive's.
    """
    spark = rows.sparkSession
    own = written(usable(rows, scale))
    with batch_rows(spark, 4_000):
        buckets = written(length_buckets(own, bucket))
    anchors = own.where(F.col("vec_id") % every == 0)
    blocks = written(anchor_blocks(anchors, anchors.count(), block))
    deals = max(1, -(-buckets.count() // DEAL))
    with batch_rows(spark, 8):
        near = _ranked(_probed(_pairs(blocks, buckets, deals), POSITIVES, True), ["block", "place"], POSITIVES)
        positives = written(near.select("block", "place", F.col("rank").alias("target"), F.col("id").alias("target_id"), F.col("score").alias("target_score")))
        targets = positives.groupBy("block").agg(F.collect_list(F.struct("place", "target", "target_id", "target_score")).alias("targets"))  # at most POSITIVES a place
        far = _probed(_pairs(blocks.join(targets, "block"), buckets, deals), NEGATIVES, False)
        ranked = _ranked(far, ["block", "place", "target"], NEGATIVES)
        return written(ranked.select("anchor_id", F.col("target_id").alias("positive_id"), "rank", F.col("id").alias("negative_id"), F.col("target_score").alias("positive_score"), F.col("score").alias("negative_score")))


def op13_lemp_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor of embeddings, some labels of which are shifted first."""
    return hard_negatives(shifted_labels(table(spark, sf_dir, "embeddings")))


ORACLE_SQL = {
    "op13_lemp_negatives": f"""
WITH v AS (
  SELECT DISTINCT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS y
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS id, CAST(round(list_dot_product(a.y, b.y)) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positive AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {POSITIVES})
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INT) AS rank,
  id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN scored USING (anchor_id)
WHERE NOT same AND {LEAST} * positive_score <= 100 * score AND 100 * score <= {MOST} * positive_score
QUALIFY rank <= {NEGATIVES}""",
}

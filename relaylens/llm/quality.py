"""Quality classifier: Bradley-Terry ranking of documents from preference pairs.

A document's score is a linear function of plain text features. A pair is a document labelled good and one labelled
bad; the probability that the good one wins is the logistic function of the difference of their scores, so the loss is
the logistic loss on feature differences. The decision threshold is a quantile of the training scores: the share of
bad labels. The published score is the logistic function of (score - threshold), so that 0.5 is the threshold.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from .common import bounded_batches, held_out, table

FEATURES = ("log_bytes", "upper", "digit", "symbol", "pipe", "high", "space", "log_words", "word_len", "distinct", "symbol_words", "upper_words", "repeat_next", "repeat_lines", "end_mark", "first_upper")
_SYMBOL = np.array([b in b"#$%&*<=>@\\^_`{|}~+!" for b in range(256)])
_UPPER = np.array([65 <= b <= 90 for b in range(256)])
_DIGIT = np.array([48 <= b <= 57 for b in range(256)])
_SPACE = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])


def text_features(text: str | None) -> list[float]:
    """Features of the whole text; null counts as empty."""
    raw = (text or "").encode("utf-8", "replace")
    n = max(len(raw), 1)
    bins = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = raw.split()
    w = max(len(words), 1)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    letters = max(int(bins[65:91].sum() + bins[97:123].sum()), 1)
    return [
        np.log1p(len(raw)), bins[_UPPER].sum() / letters, bins[_DIGIT].sum() / n, bins[_SYMBOL].sum() / n, bins[124] / n, bins[128:].sum() / n, bins[_SPACE].sum() / n,
        np.log1p(len(words)), min(len(raw) / w, 50) / 10, len(set(words)) / w, sum(map(_symbol_end, words)) / w, sum(map(bytes.isupper, words)) / w,
        sum(a == b for a, b in zip(words, words[1:])) / w, 1 - len(set(lines)) / max(len(lines), 1), float(raw[-1:] in (b".", b"!", b"?")), float(raw[:1].isupper() or raw[:1] >= b"\x80"),
    ]


def _symbol_end(word: bytes) -> bool:
    return word[-1] in b"#$%&*<=>@^_~|!"


@dataclass
class PairwiseRanker:
    """Linear Bradley-Terry scores over standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    @classmethod
    def fit(cls, x: np.ndarray, label: np.ndarray, pairs: int = 50_000, rounds: int = 300, l2: float = 1e-3, seed: int = 7) -> PairwiseRanker:
        """x: rows of features; label: 1 good, 0 bad. With only one kind of label there is no pair: all weights stay 0."""
        mean, scale = (x.mean(0), x.std(0)) if len(x) else (np.zeros(len(FEATURES)), np.ones(len(FEATURES)))
        scale = np.where(scale > 1e-9, scale, 1.0)
        z = np.clip((x - mean) / scale, -8, 8)
        good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
        w = np.zeros(x.shape[1])
        if len(good) and len(bad):
            rng = np.random.default_rng(seed)
            d = z[rng.choice(good, pairs)] - z[rng.choice(bad, pairs)]
            m, v = np.zeros_like(w), np.zeros_like(w)
            for t in range(1, rounds + 1):
                g = -(d * _sigmoid(-(d @ w))[:, None]).mean(0) + l2 * w
                m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
                w -= 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
        s = z @ w
        if len(good) and len(bad):
            at = float(np.quantile(s, len(bad) / len(x)))
        else:  # all scores are 0: they pass unless all labels are bad
            at = 1.0 if len(bad) else -1.0
        return cls(mean, scale, w, at)

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights - self.threshold)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def training_sample(docs: DataFrame, labels: DataFrame, most: int = 20_000) -> DataFrame:
    """(text, quality) of labelled rows that aren't held out: the `most` rows whose id hashes lowest, so the bound is documented.

    Null labels are left out. Of an id labelled repeatedly the smallest label counts.
    """
    rows = labels.where("quality is not null and doc_id is not null").where(~held_out()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)  # at most `most` rows of two numbers: bounded, so broadcast
    return docs.select("doc_id", "text").join(F.broadcast(rows), "doc_id")


def fit_quality(docs: DataFrame, labels: DataFrame, most: int = 20_000) -> PairwiseRanker:
    """Features are made on the executors; the driver gets at most `most` rows of them."""

    def rows(batches):
        for b in batches:
            x = np.array([text_features(t) for t in b.column("text").to_pylist()]).reshape(b.num_rows, len(FEATURES))
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), b.column("quality").cast(pa.int32()), *(pa.array(x[:, i]) for i in range(len(FEATURES)))], ["doc_id", "quality", *FEATURES])

    got = training_sample(docs, labels, most).mapInArrow(rows, "doc_id long, quality int, " + ", ".join(f"{f} double" for f in FEATURES)).orderBy("doc_id", *FEATURES).limit(most).toPandas()
    return PairwiseRanker.fit(got[list(FEATURES)].to_numpy(float), got["quality"].to_numpy())


def score_quality(docs: DataFrame, model: PairwiseRanker, keep: list[str], names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """The columns `keep` of docs with, under `names`, score (0 to 1) and predicted (1 from 0.5 on).

    Null and empty texts have a score too. A kept column called like a new one gives way to it.
    """
    keep = [k for k in keep if k not in names]
    schema = StructType([*docs.select(*keep).schema, StructField(names[0], DoubleType()), StructField(names[1], IntegerType())])

    def rows(batches):
        for b in batches:
            s = model.score(np.array([text_features(t) for t in b.column("text").to_pylist()]).reshape(b.num_rows, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in keep), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], [*keep, *names])

    return bounded_batches(docs).select(*dict.fromkeys(["text", *keep])).mapInArrow(rows, schema)


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted of every document; learned from labels of rows that aren't held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, model, ["doc_id"]).select("doc_id", held_out().alias("held_out"), "score", "predicted")

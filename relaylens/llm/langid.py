"""Language identification by rank-order profiles of character n-grams.

A language's profile is its most frequent n-grams in rank order. A document is compared by the out-of-place distance:
the sum, over its own most frequent n-grams, of how far each one's rank lies from its rank in the profile (an n-gram
that the profile lacks counts as the profile's length). The closest profile wins.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .common import bounded_batches, held_out, table, written

ORDERS = (1, 2, 3)
#: Fixed value: the result for a text that is null or has no letter.
UNDETERMINED = "und"


def _letters() -> np.ndarray:
    """For each code point: itself if it is a letter, its lower case if that is one code point, else 0."""
    out = np.zeros(0x110000, np.int64)
    for i in range(0x110000):
        if (c := chr(i)).isalpha():
            out[i] = ord(low) if len(low := c.lower()) == 1 else i
    return out


_TABLE: list[np.ndarray] = []


def ngram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram codes of a whole text and their counts. Runs of other characters than letters count as one gap."""
    if not _TABLE:
        _TABLE.append(_letters())
    x = np.frombuffer((text or "").encode("utf-32-le", "replace"), np.uint32)
    x = _TABLE[0][x]
    if not x.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    gap = x == 0
    x = np.concatenate([[0], x[~(gap & np.concatenate([[True], gap[:-1]]))], [0]])
    codes = []
    for n in ORDERS:
        g = np.zeros(max(len(x) - n + 1, 0), np.int64)
        for i in range(n):
            g = (g << 21) | x[i : i + len(g)]
        codes.append(g[g != 0] if n == 1 else g)
    return np.unique(np.concatenate(codes), return_counts=True)


def ranked(codes: np.ndarray, counts: np.ndarray, top: int) -> np.ndarray:
    """The most frequent codes, most frequent first; of equal counts the smaller code first."""
    if len(codes) > 4 * top:  # whatever counts less than the top-th can't be among them
        least = np.partition(counts, len(counts) - top)[len(counts) - top]
        codes, counts = codes[counts >= least], counts[counts >= least]
    return codes[np.lexsort((codes, -counts))[:top]]


@dataclass
class RankProfiles:
    """languages in alphabetical order, with each one's n-gram codes (sorted) and their ranks."""

    languages: list[str]
    codes: list[np.ndarray]
    ranks: list[np.ndarray]
    top: int

    def distances(self, doc: np.ndarray) -> np.ndarray:
        """Out-of-place distance to each language, as a share of the greatest possible one."""
        place = np.arange(len(doc))
        out = []
        for codes, ranks in zip(self.codes, self.ranks):
            at = np.minimum(np.searchsorted(codes, doc), max(len(codes) - 1, 0))
            far = np.where(codes[at] == doc, np.minimum(np.abs(ranks[at] - place), self.top), self.top) if len(codes) else np.full(len(doc), self.top)
            out.append(far.sum() / (self.top * len(doc)))
        return np.array(out)

    def predict(self, text: str | None) -> tuple[str, float]:
        doc = ranked(*ngram_counts(text), self.top)
        if not len(doc) or not self.languages:
            return UNDETERMINED, 0.0
        d = self.distances(doc)
        best = int(d.argmin())  # of equal distances the first language
        return self.languages[best], float(1 - d[best])


def training_ids(rows: DataFrame, most: int) -> DataFrame:
    """lang, doc_id of the `most` different ids of each language that hash lowest."""
    ids = rows.select("lang", "doc_id", F.xxhash64("doc_id").alias("h"))
    sizes = written(ids.groupBy("lang").agg(F.approx_count_distinct("doc_id", 0.02).alias("n"))).withColumnRenamed("lang", "l")
    # Hashes are spread evenly, so below this share of their range lie about twice the ids wanted; only these are ranked.
    share = F.least(F.lit(1.0), F.lit(2.0 * most) / F.greatest(F.col("n"), F.lit(1)))
    near = ids.join(sizes, F.col("lang") == F.col("l")).where((F.col("h").cast("double") + 2.0**63) / 2.0**64 <= share).select("lang", "doc_id", "h").distinct()
    return near.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id"))).where(F.col("n") <= most).select("lang", "doc_id")


def fit_profiles(docs: DataFrame, most: int = 2_000, top: int = 400) -> RankProfiles:
    """Profiles from a bounded sample: for each language the `most` documents whose id hashes lowest, none held out.

    The bound is documented and per language: n-gram counts are summed on the executors, and the driver gets `top`
    rows a language. Rows with a null text, language or id are left out. Of several rows of one id and language the text
    that hashes lowest counts, so an id that is on many rows is one document. The sample's ids are a written table, which
    Spark broadcasts below its threshold.
    """
    rows = docs.select("doc_id", "lang", "text").where("text is not null and lang is not null and doc_id is not null").where(~held_out())
    first = written(training_ids(rows, most)).select(F.col("lang").alias("l"), F.col("doc_id").alias("d"))

    def grams(batches):
        for b in batches:
            per = {}
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                per.setdefault(lang, []).append(ngram_counts(text))
            for lang, found in per.items():
                codes, counts = np.concatenate([c for c, _ in found]), np.concatenate([n for _, n in found])
                u, at = np.unique(codes, return_inverse=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(u), pa.string()), pa.array(u), pa.array(np.bincount(at, counts, len(u)).astype(np.int64))], ["lang", "code", "n"])

    sample = rows.join(first, (F.col("lang") == F.col("l")) & (F.col("doc_id") == F.col("d")), "left_semi")
    sample = sample.groupBy("lang", "doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t")).select("lang", "t.text")
    total = sample.mapInArrow(grams, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    best = total.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))).where(F.col("r") <= top).select("lang", "code", "r").toPandas()
    languages, codes, ranks = sorted(best.lang.unique()), [], []
    for lang in languages:
        own = best[best.lang == lang].sort_values("code")
        codes.append(own.code.to_numpy(np.int64))
        ranks.append(own.r.to_numpy(np.int64) - 1)
    return RankProfiles(languages, codes, ranks, top)


def identify(docs: DataFrame, model: RankProfiles, keep: list[str], names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """The columns `keep` of docs with, under `names`, the language and 1 - distance.

    A text that is null or without a letter gets `und` and 0. A kept column called like a new one gives way to it.
    """
    keep = [k for k in keep if k not in names]
    schema = StructType([*docs.select(*keep).schema, StructField(names[0], StringType()), StructField(names[1], DoubleType())])

    def rows(batches):
        for b in batches:
            got = [model.predict(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in keep), pa.array([x for x, _ in got], pa.string()), pa.array([s for _, s in got], pa.float64())], [*keep, *names])

    return bounded_batches(docs).select(*dict.fromkeys(["text", *keep])).mapInArrow(rows, schema)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return identify(docs, fit_profiles(docs), ["doc_id"]).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")

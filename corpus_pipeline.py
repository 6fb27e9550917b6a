"""Corpus pipeline: documents in, token counts and digests of the documents that are kept out.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept. All but the last return the
columns of docs. Every stage decides by row: where doc_id is null or repeated, the join and the decontamination number the
rows, so that of equal rows one stays, and a contaminated row goes alone.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relaylens.llm import bpe, langid, partenum, quality, winnow
from relaylens.llm.common import shared_folder, table, without, written

#: A document whose language is declared goes if another one is predicted with at least this score.
SURE = 0.5


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that the ranking puts at or above its threshold; learned from labels of documents still here."""
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, model, docs.columns, ("__score", "__good")).where("__good = 1").select(*docs.columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents of a known language: not undetermined, and not surely in another one than they declare."""
    found = langid.identify(docs, langid.fit_profiles(docs), docs.columns, ("__lang", "__near"))
    other = F.col("lang").isNotNull() & (F.col("__lang") != F.col("lang")) & (F.col("__near") >= SURE)
    return found.where((F.col("__lang") != langid.UNDETERMINED) & ~F.coalesce(other, F.lit(False))).select(*docs.columns)


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with a column that names each row: doc_id where it does so already, else a number, which is written with the rows."""
    n = docs.agg(F.count_distinct("doc_id").alias("ids"), F.count(F.lit(1)).alias("rows")).first()
    if n["ids"] == n["rows"]:
        return docs, "doc_id"
    name = next(c for c in ("__row" + "_" * k for k in range(len(docs.columns) + 1)) if c not in docs.columns)
    return written(docs.withColumn(name, F.monotonically_increasing_id())), name


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group that links connect: that of smallest doc_id, or the first one if ids don't name rows."""
    rows, name = _numbered(docs)
    groups = partenum.near_components(rows.select(F.col(name).alias("doc_id"), "text"))
    return without(rows, groups.where("component_id <> doc_id").select(F.col("doc_id").alias(name)), name).select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents without a word in a passage of a benchmark item."""
    rows, name = _numbered(docs)
    found = winnow.contamination(rows.select(F.col(name).alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    return without(rows, found.where("n_hit > 0").select(F.col("doc_id").alias(name)), name).select(*docs.columns)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the decoded bytes."""
    return bpe.encode_documents(docs, public_tokenizers.path(bpe.VOCABULARY), public_tokenizers.PATTERN, ["doc_id"])


STAGES = [
    ("quality classifier", quality_classifier),
    ("language ID", language_id),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("byte-level BPE encoding and decoding", byte_bpe),
]

#: Fitted models and tokenisation have no SQL form; tests compare stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = shared_folder(spark)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

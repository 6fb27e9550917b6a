"""Document fingerprints: bottom-k sketches of word 5-gram hashes, in SQL expressions throughout.

A sketch is the sorted array of the k least distinct hashes of a text's shingles; below k shingles it is the whole set
and every estimate is exact. The sketch of a union is the k least of both sketches, so parts merge in any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, written

K, WORDS = 128, 5


def with_sketch(df: DataFrame, text: str, name: str, k: int = K) -> DataFrame:
    """df with the sketch of a text column under `name`. Null counts as empty; an empty text has an empty sketch.

    Texts are lower-cased; words end at ASCII white space. Fewer than five words are one shingle together.
    """
    words = F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[\x09-\x0D ]+"), lambda w: w != "")
    df = df.withColumn("__words", F.transform(words, lambda w: F.xxhash64(w)))
    w, n = F.col("__words"), F.size("__words")
    runs = F.transform(F.sequence(F.lit(0), n - WORDS), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(WORDS)]))
    shingles = F.when(n >= WORDS, runs).when(n > 0, F.array(F.xxhash64(w))).otherwise(F.array().cast("array<bigint>"))
    return df.withColumn(name, F.slice(F.sort_array(F.array_distinct(shingles)), 1, k)).drop("__words")


def merged(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of two texts' shingles."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_by(df: DataFrame, by: list[str], sketch: str, k: int = K) -> DataFrame:
    """One sketch for each group of rows: the k least hashes of the group, ranked with a limit before the shuffle.

    A group with a third of all rows sends at most k rows a task. Groups of empty sketches only get an empty one.
    """
    rows = df.select(*by, F.explode_outer(sketch).alias("__h")).distinct()
    order = Window.partitionBy(*by).orderBy(F.col("__h").asc_nulls_last())
    least = rows.withColumn("__n", F.row_number().over(order)).where(F.col("__n") <= k)
    return least.groupBy(*by).agg(F.sort_array(F.collect_list("__h")).alias(sketch))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity: the share of the union's sketch that both sketches hold. Two empty sets: 1."""
    # What both hold of the union's sketch: their common hashes up to its greatest. The union stands in an array of one, so
    # that it is made once and not for each hash.
    both = F.get(F.transform(F.array(merged(a, b, k)), lambda u: F.size(F.filter(F.array_intersect(a, b), lambda h: h <= F.element_at(u, -1))) / F.greatest(F.size(u), F.lit(1))), F.lit(0))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(both)


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: exact below k, else (k - 1) over the k-th hash as a share of all hashes."""
    share = (F.element_at(a, -1).cast("double") + 2.0**63) / 2.0**64
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has too; 1 for an empty a."""
    common = resemblance(a, b, k) * distinct_shingles(merged(a, b, k), k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), common / distinct_shingles(a, k)))


def fingerprint(a: Column) -> Column:
    """The sketch as text: its hashes, joined by commas."""
    return F.array_join(a.cast("array<string>"), ",")


#: What names a document: its id, whether that is null, and the hash of its text. Plain columns, so that one partitioning
#: by them serves all joins below.
NAME = ["did", "unnamed", "key"]


def named(docs: DataFrame) -> DataFrame:
    """did, unnamed, key, text of each row; a null text is empty."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.select(F.coalesce("doc_id", F.lit(0)).cast("long").alias("did"), F.col("doc_id").isNull().alias("unnamed"), F.xxhash64("text").alias("key"), "text")


def neighbours(texts: DataFrame) -> DataFrame:
    """NAME, n_chars and prev_<NAME>, prev_chars of each distinct document.

    Documents are ordered by (doc_id, key), null ids first; before the first comes the last. Only these narrow rows are
    range-partitioned; each range finds its first row's predecessor in a row a range.
    """
    spark = texts.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("unnamed").desc(), F.col("did"), F.col("key")]
    ids = texts.select(*NAME, F.char_length("text").cast("long").alias("n_chars")).distinct()
    ids = written(ids.repartitionByRange(ranges, *order).withColumn("range", F.spark_partition_id()))
    me = F.struct(*NAME, "n_chars")
    last = ids.groupBy("range").agg(F.max(F.struct((~F.col("unnamed")).alias("a"), "did", "key", me.alias("me"))).alias("x")).select("range", F.col("x.me").alias("me"))
    every = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # A row a range, so one task orders as many rows as there are shuffle partitions.
    before = last.select("range", F.coalesce(F.lag("me").over(Window.orderBy("range")), F.last("me").over(every)).alias("before"))
    own = Window.partitionBy("range").orderBy(*order)
    prev = F.coalesce("prev", "before")
    rows = ids.select("range", *NAME, "n_chars", F.lag(me).over(own).alias("prev")).join(before, "range")
    return rows.select(*NAME, "n_chars", *[prev[c].alias(f"prev_{c}") for c in NAME], prev["n_chars"].alias("prev_chars"))


def edited_pairs(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, text, edited, next_sketch of each row of docs (doc_id, text).

    edited: the last quarter of the code points is replaced by as many first ones of the next document, or by all of
    them. Texts are shuffled once, by name; the next document sends its sketch and the code points needed.
    """
    texts = named(docs)
    rows = texts.join(written(neighbours(texts)), NAME)
    quarter = lambda n: F.floor(n / 4).cast("int")
    sent = with_sketch(rows.select(*[f"prev_{c}" for c in NAME], "prev_chars", "text"), "text", "next_sketch")
    sent = sent.select(*[F.col(f"prev_{c}").alias(c) for c in NAME], "next_sketch", F.substr("text", F.lit(1), quarter(F.col("prev_chars"))).alias("start"))
    sent = sent.dropDuplicates(NAME)  # rows that repeat a document send the same
    joined = rows.select(*NAME, "n_chars", "text").join(sent, NAME)  # the same columns of texts as above, so one shuffle serves both
    kept = F.substr("text", F.lit(1), (F.col("n_chars") - quarter(F.col("n_chars"))).cast("int"))
    return joined.select(F.when(~F.col("unnamed"), F.col("did")).alias("doc_id"), "n_chars", "text", F.concat(kept, "start").alias("edited"), "next_sketch")


def op3_bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_shingles of every document."""
    rows = edited_pairs(table(spark, sf_dir, "documents"))
    rows = with_sketch(with_sketch(rows, "text", "own").drop("text"), "edited", "other")
    own, other, after = F.col("own"), F.col("other"), F.col("next_sketch")
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(own).alias("fingerprint"), fingerprint(other).alias("edited_fingerprint"),
        resemblance(own, other).alias("near_edited"), resemblance(own, after).alias("near_next"),
        distinct_shingles(own).alias("n_shingles"),
    )

"""Benchmark decontamination by winnowing.

Of each run of SPAN - GRAM + 1 consecutive 5-grams the one of least hash is kept as a fingerprint, so every span of
SPAN words that a document and a benchmark item share gives both the same fingerprint at the same word. Fingerprints
are joined on the hash, and each hit is extended to the left and right over equal words: runs of SPAN words count.
Items of fewer words are one window each and are looked up by the hash of the whole item.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WordHashes, bounded_batches, gram_hashes, mix, table, written

SPAN, GRAM = 10, 5
#: Words to each side of a fingerprint that a span of SPAN words round it can reach, and the whole context.
SIDE = SPAN - GRAM
AROUND = 2 * SIDE + GRAM
#: Bits of the filter by which documents' fingerprints are thinned out before the join; its size is fixed.
FILTER_BITS = 22
_KEEP = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def item_words(text: str | None) -> list[bytes]:
    """A-Z lower-cased; words are runs of ASCII letters, digits and other than ASCII characters."""
    return (text or "").encode("utf-8", "replace").lower().translate(_KEEP).split()


def winnowed(grams: np.ndarray, window: int) -> np.ndarray:
    """Positions of the least hash (of equals the leftmost) of each run of `window` hashes."""
    if len(grams) < window:
        return np.empty(0, np.int64)
    runs = np.lib.stride_tricks.sliding_window_view(grams, window)
    return np.unique(runs.argmin(1) + np.arange(len(runs)))


def _contexts(words: np.ndarray, at: np.ndarray, outside: int) -> np.ndarray:
    """Word hashes round each fingerprint; `outside` where the text has ended."""
    padded = np.concatenate([np.full(SIDE, outside, np.uint64), words, np.full(SIDE, outside, np.uint64)])
    return padded[at[:, None] + np.arange(AROUND)]




def item_fingerprints(items: DataFrame) -> DataFrame:
    """hash, item_id, span, context of benchmark items: span is 0 for a winnowed fingerprint, else a short item's words."""

    def rows(batches):
        hashes = WordHashes()
        for b in batches:
            out = []
            for item, t in zip(b.column("item_id").to_pylist(), b.column("text").to_pylist()):
                w = hashes.of(item_words(t))
                if len(w) >= SPAN:
                    g = gram_hashes(w, GRAM)
                    at = winnowed(g, SPAN - GRAM + 1)
                    out += [(h, item, 0, c.tobytes()) for h, c in zip(g[at].view(np.int64).tolist(), _contexts(w, at, 1))]
                elif len(w):
                    out.append((int(_short(w, len(w)).view(np.int64)[0]), item, len(w), b""))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.string(), pa.int32(), pa.binary()))], ["hash", "item_id", "span", "item_context"])

    return items.select(F.col("item_id").cast("string").alias("item_id"), "text").mapInArrow(rows, "hash long, item_id string, span int, item_context binary")


def _short(words: np.ndarray, n: int) -> np.ndarray:
    return mix(gram_hashes(words, n) + np.uint64(n))


def hash_filter(fingerprints: DataFrame) -> np.ndarray:
    """A bit for each value that a hash's low FILTER_BITS bits take: never larger than 2**FILTER_BITS bits."""
    low = fingerprints.select((F.col("hash").bitwiseAND((1 << FILTER_BITS) - 1)).alias("low")).distinct().toPandas()["low"].to_numpy(np.int64)
    bits = np.zeros(1 << FILTER_BITS, bool)
    bits[low] = True
    return np.packbits(bits)


def document_fingerprints(docs: DataFrame, bits: np.ndarray, short: list[int]) -> DataFrame:
    """doc_id, text_key, n_words of every row, with the fingerprints that the filter lets through."""

    def rows(batches):
        hashes, known = WordHashes(), np.unpackbits(bits).astype(bool)
        mask = np.uint64((1 << FILTER_BITS) - 1)
        for b in batches:
            keys, n_words, found = [], [], []
            for t in b.column("text").to_pylist():
                w = hashes.of(item_words(t))
                g, own = gram_hashes(w, GRAM), []
                at = winnowed(g, SPAN - GRAM + 1)
                at = at[known[(g[at] & mask).astype(np.int64)]]
                if len(at):
                    own += [{"hash": h, "at": p, "span": 0, "context": c.tobytes()} for h, p, c in zip(g[at].view(np.int64).tolist(), at.tolist(), _contexts(w, at, 0))]
                for n in short:
                    s = _short(w, n) if len(w) >= n else g[:0]
                    at = np.flatnonzero(known[(s & mask).astype(np.int64)])
                    own += [{"hash": h, "at": p, "span": n, "context": b""} for h, p in zip(s[at].view(np.int64).tolist(), at.tolist())]
                keys.append(xxhash.xxh3_64_intdigest(t or "") - (1 << 63))
                n_words.append(len(w))
                found.append(own)
            kind = pa.list_(pa.struct([("hash", pa.int64()), ("at", pa.int32()), ("span", pa.int32()), ("context", pa.binary())]))
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), pa.array(keys, pa.int64()), pa.array(n_words, pa.int64()), pa.array(found, kind)], ["doc_id", "text_key", "n_words", "found"])

    return docs.select("doc_id", "text").mapInArrow(rows, "doc_id long, text_key long, n_words long, found array<struct<hash:bigint,at:int,span:int,context:binary>>")


def _extend(batches):
    """Hits of SPAN words or more: from word `start` on `length` words."""
    for b in batches:
        keep = [b.column(c) for c in ("doc_id", "text_key", "set")]
        at, span = b.column("at").to_numpy(), b.column("span").to_numpy()
        start, length = at.astype(np.int64), span.astype(np.int64)
        k = np.flatnonzero(span == 0)
        if len(k):
            mine, theirs = (np.frombuffer(b"".join(b.column(c).take(pa.array(k)).to_pylist()), np.uint64).reshape(-1, AROUND) for c in ("context", "item_context"))
            same = mine == theirs
            left = np.cumprod(same[:, :SIDE][:, ::-1], 1).sum(1)
            right = np.cumprod(same[:, SIDE + GRAM :], 1).sum(1)
            whole = same[:, SIDE : SIDE + GRAM].all(1)
            start[k], length[k] = at[k] - left, np.where(whole, left + GRAM + right, 0)
        ok = pa.array((span > 0) | (length >= SPAN))
        yield pa.RecordBatch.from_arrays([*keep, pa.array(start), pa.array(length)], ["doc_id", "text_key", "set", "start", "length"]).filter(ok)


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, text_key, n_words, n_hit, items (sorted ids as strings) of every row of docs.

    Items of equal words are one in the join and are listed each in the result. Null and empty texts have no words and
    no hits. Rows of equal doc_id and text get equal results.
    """
    prints = written(item_fingerprints(items))
    short = sorted(r[0] for r in prints.where("span > 0").select("span").distinct().collect())
    rows = written(document_fingerprints(bounded_batches(docs), hash_filter(prints), short))
    # Equal fingerprints of items with equal surroundings are met once by the documents, and name their items by one number.
    same = prints.groupBy("hash", "span", "item_context").agg(F.sort_array(F.collect_set("item_id")).alias("ids"))
    same = written(same.withColumn("set", F.xxhash64("ids")))
    hits = rows.select("doc_id", "text_key", F.explode("found").alias("f")).select("doc_id", "text_key", "f.*")
    joined = hits.join(same.drop("ids"), ["hash", "span"]).select("doc_id", "text_key", "set", "at", "span", "context", "item_context")
    runs = joined.mapInArrow(_extend, "doc_id long, text_key long, set long, start long, length long")
    per = runs.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("start", "length")).alias("runs"), F.collect_set("set").alias("sets"))

    def total(batches):
        for b in batches:
            n = []
            for runs in b.column("runs").to_pylist():
                upto = hit = 0
                for s, e in sorted((r["start"], r["start"] + r["length"]) for r in runs):
                    hit += max(0, e - max(s, upto))
                    upto = max(upto, e)
                n.append(hit)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_key"), pa.array(n, pa.int64()), b.column("sets")], ["doc_id", "text_key", "n_hit", "sets"])

    hit = written(per.mapInArrow(total, "doc_id long, text_key long, n_hit long, sets array<long>").withColumnsRenamed({"doc_id": "d", "text_key": "k"}))
    items_of = hit.select("d", "k", F.explode("sets").alias("set")).join(same.select("set", "ids").dropDuplicates(["set"]), "set")
    listed = items_of.groupBy("d", "k").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("items"))
    named = listed.select(F.col("d").alias("e"), F.col("k").alias("f"), "items")
    hit = written(hit.join(named, F.col("d").eqNullSafe(F.col("e")) & (F.col("k") == F.col("f"))).select("d", "k", "n_hit", "items"))
    both = rows.select("doc_id", "text_key", "n_words").join(hit, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k")), "left")
    return both.select("doc_id", "text_key", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def op8_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))

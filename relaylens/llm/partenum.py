"""Jaccard join of documents' word 5-gram sets through PartEnum signatures.

Sets with Jaccard similarity of at least 3/4 differ in few elements: with sizes a and b, in at most (a + b) / 7. Sizes
are cut into bands of ratio 4/3, so such sets lie in the same band or in neighbours, and each set works for its own
band and the next. For a band the domain of shingles is cut into first-level parts, each of these into second-level
parts; by counting, some first-level part holds at most one difference, which spoils one of its second-level parts. So
a signature is made of each subset of the second-level parts that leaves one out, and similar sets share one.

Two facts keep this small without losing a link. Equal sets are one node from the start. And shingles that
occur in no other set bound the size of a set's partners: most sets have no partner at all and get no signatures, and
pairs beyond the bound aren't compared.

Candidates are not all pairs that share a signature. First each set is compared with one centre, the set that it
shares most signatures with. Then, where a signature's members still lie in several components, they are compared with
a pivot, the first set of the component that most of them are in, and written as their edits of it, those that many sets
have last. Two near sets of which one isn't near the pivot share more of their edits than most sets do that lie just
below the threshold, so that they meet at an edit among few of each, and among fewer still of one of them: a prefix
filter over edits. Only such pairs are compared after that.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WordHashes, bounded_batches, connected_components, gram_hashes, mix, table, written

WORDS = 5
#: Similarity 3/4 as a fraction; the bounds on differences below follow from it.
NEAR, OF = 3, 4
FLUSH = 250_000
BUCKET = 1_000_000
BROADCAST_ROWS = 500_000
#: Sets of a pivot by which its edits are put in order.
SAMPLE = 64
_U = np.uint64


def shingle_set(text: str | None, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of a whole text's 5-word shingles; A-Z are lower-cased, words end at ASCII white space.

    With fewer words the whole sequence is the one shingle; without words there is none.
    """
    words = (text or "").encode("utf-8", "replace").lower().split()
    return np.unique(gram_hashes(hashes.of(words), min(WORDS, len(words)))) if words else np.empty(0, np.uint64)


def _set_key(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def _node(key: bytes) -> int:
    return int.from_bytes(key[:8], "little", signed=True)


def set_keys(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set_key (128 bits; null for an empty set), tag (its first 64 bits) of every row."""

    def rows(batches):
        hashes = WordHashes()
        for b in batches:
            n, keys = [], []
            for t in b.column("text").to_pylist():
                s = shingle_set(t, hashes)
                n.append(len(s))
                keys.append(_set_key(s) if len(s) else None)
            tags = pa.array([k and _node(k) for k in keys], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), tags], ["doc_id", "n_shingles", "set_key", "tag"])

    return docs.select("doc_id", "text").mapInArrow(rows, "doc_id long, n_shingles long, set_key binary, tag long")


def lone_shingles(docs: DataFrame, buckets: int) -> DataFrame:
    """tag (of a set), lone: how many of its shingles no other set has. Sets without such shingles have no row.

    Shingles are dealt to buckets by their hash, packed in 5 bytes each. What several sets of one batch share is sent
    once, as shared, so a shingle that a third of all documents have costs a row a batch.
    """

    def pack(tags: list[int], sets: list[np.ndarray]):
        x = np.concatenate(sets)
        tag = np.repeat(np.array(tags, np.int64), [len(s) for s in sets])
        order = np.argsort(x, kind="stable")
        x, tag = x[order], tag[order]
        first = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
        tag = np.where(np.diff(np.append(first, len(x))) > 1, 0, tag[first])
        x = x[first]
        p = ((x >> _U(40)) % _U(buckets)).astype(np.int32)
        order = np.lexsort((tag, p))
        x, tag, p = x[order], tag[order], p[order]
        low = np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5])
        at = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]]))
        out = []
        for a, z in zip(at, np.append(at[1:], len(p))):
            ids, counts = np.unique(tag[a:z], return_counts=True)
            out.append((int(p[a]), ids.tobytes(), counts.astype(np.int32).tobytes(), low[a:z].tobytes()))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.binary(), pa.binary(), pa.binary()))], ["bucket", "tags", "counts", "low"])

    def send(batches):
        hashes, tags, sets, seen, size = WordHashes(), [], [], set(), 0
        for b in batches:
            for t in b.column("text").to_pylist():
                s = shingle_set(t, hashes)
                if len(s) and (tag := _node(_set_key(s))) not in seen:
                    seen.add(tag)
                    tags.append(tag)
                    sets.append(s)
                    size += len(s)
                    if size >= FLUSH:
                        yield pack(tags, sets)
                        tags, sets, seen, size = [], [], set(), 0
        if sets:
            yield pack(tags, sets)

    def count(batches):
        xs, tags = [], []
        for b in batches:
            for p, ids, counts, low in zip(*(b.column(k).to_pylist() for k in ("bucket", "tags", "counts", "low"))):
                ids, counts = np.frombuffer(ids, np.int64), np.frombuffer(counts, np.int32)
                wide = np.zeros((len(low) // 5, 8), np.uint8)
                wide[:, :5] = np.frombuffer(low, np.uint8).reshape(-1, 5)
                xs.append(wide.view("<u8").ravel() | _U(p << 40))
                tags.append(np.repeat(ids, counts))
        if not xs:
            return
        x, tag = np.concatenate(xs), np.concatenate(tags)
        order = np.argsort(x)
        x, tag = x[order], tag[order]
        at = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
        lo, hi = np.minimum.reduceat(tag, at), np.maximum.reduceat(tag, at)
        ids, n = np.unique(lo[(lo == hi) & (lo != 0)], return_counts=True)
        for k in range(0, len(ids), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(ids[k : k + 100_000]), pa.array(n[k : k + 100_000].astype(np.int64))], ["tag", "lone"])

    sent = docs.select("text").mapInArrow(send, "bucket int, tags binary, counts binary, low binary")
    return sent.repartition(buckets, "bucket").mapInArrow(count, "tag long, lone long").groupBy("tag").agg(F.sum("lone").alias("lone"))


def _bands(largest: int) -> np.ndarray:
    at = [1]
    while at[-1] <= largest:
        at.append(-(-at[-1] * OF // NEAR))
    return np.array([*at, -(-at[-1] * OF // NEAR), -(-(-(-at[-1] * OF // NEAR)) * OF // NEAR)])


def _by_band(s: np.ndarray, bands: np.ndarray):
    """(band, signatures, spare) of a sorted set for its own size band and the next; the last bit of a signature is its band's.

    spare: how many of these signatures a set may leave out, whichever it chooses, if all others do so too. A near set
    shares one at least of each first-level part with at most one difference; each of two leaves out less than half.
    """
    own = int(np.searchsorted(bands, len(s), "right")) - 1
    value = mix(s)
    high, low = s >> _U(32), s & _U(0xFFFFFFFF)
    for band in (own, own + 1):
        k = 2 * (int(bands[band + 1]) - 1) // 7  # most differences of two sets of which this band has the larger
        if k == 0:
            continue  # equal sets only, and these are one node
        if k <= 6:
            parts, each = 1, k + 2
        else:
            parts, each = k // 2 + 1, 3
            parts += max(2, parts // 4)
        cell = ((high * _U(parts)) >> _U(32)) * _U(each) + ((low * _U(each)) >> _U(32))
        cell = cell.astype(np.int64)
        sums, size = np.zeros(parts * each, np.uint64), np.bincount(cell, minlength=parts * each).reshape(parts, each)
        np.add.at(sums, cell, value)
        sums = sums.reshape(parts, each)
        # A shared signature of no elements says nothing. A set needs it only where all parts that are sure to hold no
        # difference (at most one, with two levels) may be empty, given the most differences to any partner of its size.
        most = min(k, (len(s) + len(s) * OF // NEAR) // 7)
        if parts == 1:  # at most k second-level parts differ: keep each two of the k + 2
            a, b = np.triu_indices(each, 1)
            sub, left = sums[0][a] + sums[0][b], size[0][a] + size[0][b]
            sure, spare = (size == 0).sum() < each - most, 0
        else:
            sub, left = (sums.sum(1, dtype=np.uint64)[:, None] - sums).ravel(), (size.sum(1)[:, None] - size).ravel()
            common = parts - most // 2 - int((left.reshape(parts, each) == 0).any(1).sum())
            sure, spare = common > 0, max(0, (common - 1) // 2)
        keep = left > 0 if sure else np.full(len(sub), True)
        place = mix(np.arange(len(sub), dtype=np.uint64) + _U(band << 40))
        yield band, mix(sub + place)[keep] & ~_U(1) | _U(band & 1), spare


def signatures(s: np.ndarray, bands: np.ndarray) -> np.ndarray:
    """PartEnum signatures of a sorted set, for its own size band and the next."""
    return np.concatenate([np.empty(0, np.uint64), *(sigs for _, sigs, _ in _by_band(s, bands))])


def signature_rows(sets: DataFrame) -> DataFrame:
    """sig, node, n, room for sets (node, n, room, shingles)."""

    def rows(batches):
        for b in batches:
            about = [b.column(c).to_numpy() for c in ("node", "n", "room")]
            sets_ = [np.frombuffer(x.as_buffer(), np.uint64) for x in b.column("shingles")]
            bands = _bands(max((len(s) for s in sets_), default=1))
            for k in range(0, len(sets_), 200):
                sigs = [signatures(s, bands) for s in sets_[k : k + 200]]
                times = [len(x) for x in sigs]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sigs).view(np.int64)), *(pa.array(np.repeat(x[k : k + 200], times)) for x in about)], ["sig", "node", "n", "room"])

    return sets.select("node", "n", "room", "shingles").mapInArrow(rows, "sig long, node long, n int, room int")


def spare_rows(sets: DataFrame) -> DataFrame:
    """node, spare_even, spare_odd: how many signatures of bands of either parity a node may leave out."""

    def rows(batches):
        for b in batches:
            sets_ = [np.frombuffer(x.as_buffer(), np.uint64) for x in b.column("shingles")]
            bands = _bands(max((len(s) for s in sets_), default=1))
            spare = np.zeros((len(sets_), 2), np.int64)
            for i, s in enumerate(sets_):
                for band, _, n in _by_band(s, bands):
                    spare[i, band & 1] = n
            yield pa.RecordBatch.from_arrays([b.column("node"), pa.array(spare[:, 0]), pa.array(spare[:, 1])], ["node", "spare_even", "spare_odd"])

    found = sets.select("node", "shingles").mapInArrow(rows, "node long, spare_even long, spare_odd long")
    return found.groupBy("node").agg(F.min("spare_even").alias("spare_even"), F.min("spare_odd").alias("spare_odd"))


def needed(family: DataFrame, sets: DataFrame) -> DataFrame:
    """Those rows of family (node, pivot, component, even, odd) that no near set can miss.

    even, odd: by how many signatures of bands of either parity a node has its pivot. A node leaves out the pivots that it
    has by the fewest, as many as its spare signatures allow.
    """
    upto = Window.partitionBy("node").orderBy(F.col("even") + F.col("odd"), "pivot").rowsBetween(Window.unboundedPreceding, 0)
    spare = spare_rows(sets.join(family.select("node").distinct(), "node", "left_semi"))
    out = family.join(spare, "node").withColumn("e", F.sum("even").over(upto)).withColumn("o", F.sum("odd").over(upto))
    return out.where("e > spare_even or o > spare_odd").select("node", "pivot", "component")


def _counts(s: np.ndarray) -> bytes:
    """How many of a set's elements fall in each of 256 bins, 255 at most."""
    return np.minimum(np.bincount((s & _U(255)).astype(np.int64), minlength=256), 255).astype(np.uint8).tobytes()


def links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those (src, dst) of pairs whose sets are near: 4 * intersection >= 3 * union, by comparing the sets whole.

    Sets are sent only for pairs whose bin counts allow so few differences: near sets differ in (a + b) / 7 elements at
    most, and in no fewer than their counts do.
    """

    def may(batches):
        for b in batches:
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint8).reshape(-1, 256).astype(np.int16) for c in ("x", "y"))
            sizes = b.column("n").to_numpy() + b.column("m").to_numpy()
            yield pa.RecordBatch.from_arrays([b.column("src"), b.column("dst")], ["src", "dst"]).filter(pa.array(7 * np.abs(x - y).sum(1) <= sizes))

    def rows(batches):
        for b in batches:
            near = []
            for x, y in zip(b.column("x"), b.column("y")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
                near.append(OF * both >= NEAR * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([b.column("src"), b.column("dst")], ["src", "dst"]).filter(pa.array(near, pa.bool_()))

    def both(pairs: DataFrame, column: str) -> DataFrame:
        x = sets.select(F.col("node").alias("src"), F.col(column).alias("x"), "n", "room")
        y = sets.select(F.col("node").alias("dst"), F.col(column).alias("y"), F.col("n").alias("m"), F.col("room").alias("yroom"))
        return pairs.join(x, "src").join(y, "dst").where(f"{OF} * least(n, m) >= {NEAR} * greatest(n, m) and n <= yroom and m <= room")

    likely = written(both(pairs.select("src", "dst"), "counts").select("src", "dst", "x", "y", "n", "m").mapInArrow(may, "src long, dst long"))
    return both(likely, "shingles").select("src", "dst", "x", "y").mapInArrow(rows, "src long, dst long")


def near_sets(docs: DataFrame, classes: DataFrame, total: int, repeats: bool = True) -> DataFrame:
    """node, n, room, counts, shingles of the sets that may have a partner; classes: node (smallest doc_id of equal sets), n, tag.

    A set is one row, also if docs has the row of its node several times (repeats; without any, nothing is shuffled for it).
    """
    # A set of n shingles, `lone` of them in no other set, shares n - lone at most, and near sets of n and m share
    # 3 / 7 * (n + m) at least: so its partners have (4 n - 7 lone) / 3 shingles at most, which is its room.
    lone = lone_shingles(docs, max(64, total // BUCKET))
    maybe = written(classes.where("node is not null and n >= 3").join(lone, "tag", "left").withColumn("room", F.expr("cast(floor((4 * n - 7 * coalesce(lone, 0)) / 3) as int)")).where(f"{OF} * room >= {NEAR} * n").select("node", "tag", "room"))
    few = maybe.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS  # 16 bytes a row; beyond that Spark shuffles

    def rows(batches):
        hashes = WordHashes()
        for b in batches:
            out = []
            for node, tag, room, t in zip(*(b.column(c).to_pylist() for c in ("node", "tag", "room", "text"))):
                s = shingle_set(t, hashes)
                if len(s) and _node(_set_key(s)) == tag:  # else another text of the same doc_id
                    out.append((node, tag, len(s), room, _counts(s), s.tobytes()))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], ["node", "tag", "n", "room", "counts", "shingles"])

    joined = docs.select(F.col("doc_id").cast("long").alias("node"), "text").join(F.broadcast(maybe) if few else maybe, "node")
    sets = joined.select("node", "tag", "room", "text").mapInArrow(rows, "node long, tag long, n int, room int, counts binary, shingles binary")
    return written((sets.dropDuplicates(["node", "tag"]) if repeats else sets).drop("tag"))


def near_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of docs (doc_id, text).

    Null and empty texts have an empty set and no links: their component is their own doc_id. Rows that share a doc_id
    count as one document. A row without doc_id takes the component of its equals, else null.
    """
    docs = bounded_batches(docs)
    keys = written(set_keys(docs))
    classes = written(keys.where("set_key is not null").groupBy("set_key").agg(F.min("doc_id").alias("node"), F.max("n_shingles").alias("n"), F.max("tag").alias("tag"), F.count("*").alias("copies")))
    total = int(keys.agg(F.sum("n_shingles")).first()[0] or 0)
    repeats = keys.where("set_key is not null").groupBy("set_key", "doc_id").count().where("count > 1").limit(1).count() > 0
    components = linked(near_sets(docs, classes, total, repeats)).where("component <> node")
    own = classes.join(components, "node", "left").select("set_key", F.coalesce("component", "node").alias("component_id"), "node", "copies")
    moved = written(own.where("copies > 1 or component_id <> node").select("set_key", "component_id"))
    return keys.join(moved, "set_key", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def linked(sets: DataFrame) -> DataFrame:
    """(node, component) of all sets that have a link."""
    sigs = signature_rows(sets)
    # Most signatures are one set's alone; only the others' rows are shuffled a second time, and written.
    several = sigs.groupBy("sig").agg(F.min("node").alias("first"), F.max("node").alias("last")).where("first < last")
    sigs = written(sigs.join(several.select("sig"), "sig"))
    # The set with most room, so with fewest shingles of its own, is the centre of a signature.
    centre = F.max(F.struct(F.col("room").alias("room"), (-F.col("node")).alias("node"), F.col("n").alias("n")))
    # Its members, by sums of both halves of their hashes: of two texts under one doc_id a signature has the node twice,
    # which an exclusive or would lose.
    who = [F.sum(F.xxhash64("node").bitwiseAND(F.lit(0xFFFFFFFF))).alias("who"), F.sum(F.shiftrightunsigned(F.xxhash64("node"), 32)).alias("who2")]
    met = sigs.groupBy("sig").agg(centre.alias("c"), F.min("n").alias("least"), F.min("node").alias("first"), F.max("node").alias("last"), F.count("*").alias("m"), *who)
    met = met.select("sig", (-F.col("c.node")).alias("centre"), F.col("c.room").alias("croom"), F.col("c.n").alias("cn"), "least", "m", "who", "who2", "first", "last")
    # Signatures with the same members say the same: one of them goes on, with their number.
    one = written(met.groupBy("who", "who2", "m", "first", "last", "centre", "croom", "cn", "least").agg(F.min("sig").alias("sig"), F.count("*").alias("same"), F.sum(F.col("sig").bitwiseAND(F.lit(1))).alias("odd")).select("sig", "centre", "croom", "cn", "least", "same", "odd"))
    shared = written(sigs.join(one, "sig").where("room >= least"))
    may = "node <> centre and n <= croom and cn <= room"
    stars = shared.where(may).groupBy(F.col("node").alias("src"), F.col("centre").alias("dst")).agg(F.sum("same").alias("n"))
    best = written(stars.groupBy("src").agg(F.max_by("dst", F.struct("n", -F.col("dst"))).alias("dst")))
    edges = written(links(best, sets))
    # What is left: members of one signature in different components.
    known = written(_labels(edges))
    member = written(shared.select("sig", "node", "same", "odd").join(known, "node", "left").select("sig", "node", "same", "odd", F.coalesce("component", "node").alias("component")))
    # Their pivot: the first set of the component that most of them are in.
    parts = member.groupBy("sig", "component").count().groupBy("sig").agg(F.max_by("component", F.struct("count", -F.col("component"))).alias("pivot"), F.count("*").alias("parts"))
    family = member.join(parts.where("parts > 1").select("sig", "pivot"), "sig").where("node <> pivot")
    family = written(family.groupBy("node", "pivot", "component").agg(F.sum(F.expr("same - odd")).alias("even"), F.sum("odd").alias("odd")))
    edits = written(edited(needed(family, sets), sets))
    rest = written(edit_pairs(written(early_edits(edits))))
    return _labels(written(edges.union(edits.where("near").select(F.col("node").alias("src"), F.col("pivot").alias("dst"))).union(links(rest, sets))))


def prefix_sizes(d: int, n: int, room: int, pivot: int) -> tuple[int, int]:
    """How many of a set's d edits, in any one order, are sure to hold one that a near set shares: any set, and one that isn't near the pivot.

    Two sets differ in what one of their edits has and the other's hasn't: in d + e - 2 * shared, which is (n + m) / 7 at
    most if they are near. So they share d - (n + m) / 7 edits at least; and (d + (pivot - n) / 7) / 2 at least, more than
    none, if the other one's edits are more than (m + pivot) / 7, as they are where it isn't near the pivot. Leaving out
    one less than these, the rest of both sets' edits have one in common. pivot: the size of the pivot.
    """
    most = min(room, n * OF // NEAR)
    far = max(1, d - (n + most) // 7)
    half = max(far, (7 * d + pivot - n) // 14 + 1)
    return max(0, d - far + 1), max(0, d - half + 1)


def edited(family: DataFrame, sets: DataFrame) -> DataFrame:
    """node, pivot, component, n, room, d, near, inside, limit, short, edits for (node, pivot, component): sets as edits of their pivot.

    d: in how many shingles set and pivot differ; edits: these shingles, what the pivot lacks, which few sets share, before
    what it has more, each by hash. near: whether set and pivot are near; inside: that, or in one component. limit: among how many of its edits, in an order that all sets of the pivot share, one stands that a
    near set of another component has too; of a set inside, with sets that aren't. short: the same for a partner that isn't
    near the pivot either.
    """

    def rows(batches):
        for b in batches:
            out, flat = [], []
            for node, pivot, component, n, room, x, p in zip(*(b.column(c).to_pylist() for c in ("node", "pivot", "component", "n", "room", "x", "p"))):
                x, p = np.frombuffer(x, np.uint64), np.frombuffer(p, np.uint64)
                own = np.concatenate([y[np.argsort(mix(y))] for y in (np.setdiff1d(x, p, True), np.setdiff1d(p, x, True))])
                d = len(own)
                near = 7 * d <= n + len(p)
                long, short = prefix_sizes(d, n, room, len(p))
                inside = near or component == pivot
                out.append((node, pivot, component, n, room, d, near, inside, short if inside else long, short))
                flat.append(own)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.bool_(), pa.int32(), pa.int32())
            ends = np.cumsum([0, *(r[5] for r in out)])
            values = pa.array((np.concatenate(flat) if flat else np.empty(0, np.uint64)).view(np.int64))
            names = ["node", "pivot", "component", "n", "room", "d", "near", "inside", "limit", "short", "edits"]
            yield pa.RecordBatch.from_arrays([*(pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)], names)

    x = sets.select("node", "n", "room", F.col("shingles").alias("x"))
    p = sets.select(F.col("node").alias("pivot"), F.col("shingles").alias("p"))
    both = family.join(x, "node").join(p, "pivot").select("node", "pivot", "component", "n", "room", "x", "p")
    return both.mapInArrow(rows, "node long, pivot long, component long, n int, room int, d int, near boolean, inside boolean, limit int, short int, edits array<long>")


def common_edits(edits: DataFrame) -> DataFrame:
    """pivot, common: the edits that at least two of SAMPLE of the pivot's sets have, those of fewer sets first.

    This is for the order of edits alone, which any rule may set that all sets of the pivot share.
    """
    some = edits.withColumn("k", F.row_number().over(Window.partitionBy("pivot").orderBy(F.xxhash64("node"), "node"))).where(F.col("k") <= SAMPLE)

    def rows(batches):
        for b in batches:
            out = []
            for lists in b.column("lists").to_pylist():
                values, count = np.unique(np.concatenate([np.array(x, np.int64) for x in lists]), return_counts=True)
                order = np.argsort(count, kind="stable")
                out.append(values[order][count[order] > 1])
            yield pa.RecordBatch.from_arrays([b.column("pivot"), pa.array(out, pa.list_(pa.int64()))], ["pivot", "common"])

    return some.groupBy("pivot").agg(F.collect_list("edits").alias("lists")).mapInArrow(rows, "pivot long, common array<long>")


def early_edits(edits: DataFrame) -> DataFrame:
    """The first `limit` edits of each set, with their place `at` and `first_half`; common edits of a pivot stand last.

    If two near sets have i and j edits before the first one that they share, these are differences, so 7 * (i + j) <= n + m,
    and one of i and j is within half of that: it is in the first half of its set. So an edit that many sets share, which
    all of them have only behind so many edits of their own, brings no two of them together.
    """

    def rows(batches):
        names = ["node", "pivot", "component", "n", "room", "d", "inside", "short"]
        for b in batches:
            out = []
            for own, common, limit in zip(b.column("edits").to_pylist(), b.column("common").to_pylist(), b.column("limit").to_pylist()):
                own, common = np.array(own, np.int64), np.array(common or [], np.int64)
                order = np.argsort(common, kind="stable")
                at = np.searchsorted(common[order], own) if len(common) else np.zeros(len(own), np.int64)
                known = np.zeros(len(own), bool) if not len(common) else common[order][np.minimum(at, len(common) - 1)] == own
                last = own[known][np.argsort(order[at[known]], kind="stable")] if known.any() else own[:0]
                out.append(np.concatenate([own[~known], last])[:limit])
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(out, pa.list_(pa.int64()))], [*names, "edits"])

    both = edits.join(common_edits(edits), "pivot", "left").select("node", "pivot", "component", "n", "room", "d", "inside", "short", "limit", "edits", "common")
    first = both.mapInArrow(rows, "node long, pivot long, component long, n int, room int, d int, inside boolean, short int, edits array<long>")
    out = first.select("node", "pivot", "component", "n", "room", "d", "inside", "short", F.posexplode("edits").alias("at", "edit"))
    most = F.expr(f"least(room, floor(n * {OF} / {NEAR}))")
    return out.withColumns({"early": F.col("at") < F.col("short"), "left": F.col("d") - F.col("at"), "first_half": 14 * F.col("at") <= F.col("n") + most}).drop("short")


def edit_pairs(early: DataFrame) -> DataFrame:
    """Distinct (src, dst) of sets in different components, one of them at least not near their pivot, that may be near.

    Sets meet at an edit that they share and that is in the first half of one. If it is their first, they share no more
    edits than either has from there on.
    """
    a = early.where("first_half").select("pivot", "edit", F.col("node").alias("x"), F.col("component").alias("a"), "n", "room", "d", "inside", "early", "left")
    b = early.select(F.col("pivot").alias("q"), F.col("edit").alias("f"), F.col("node").alias("y"), F.col("component").alias("b"), F.col("n").alias("m"), F.col("room").alias("mroom"), F.col("d").alias("e"), F.col("inside").alias("f_inside"), F.col("early").alias("f_early"), F.col("left").alias("f_left"))
    wanted = "not (inside and f_inside) and (inside or f_inside or (early and f_early))"
    met = a.join(b, F.expr(f"pivot = q and edit = f and a <> b and {wanted} and n <= mroom and m <= room and {OF} * least(n, m) >= {NEAR} * greatest(n, m) and 7 * (d + e - 2 * least(left, f_left)) <= n + m"))
    return met.select(F.least("x", "y").alias("src"), F.greatest("x", "y").alias("dst")).distinct()


def _labels(edges: DataFrame) -> DataFrame:
    ends = edges.select(F.col("src").alias("id")).union(edges.select("dst")).distinct()
    return connected_components(ends, edges).select(F.col("id").alias("node"), "component")


def op7_partenum_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    return near_components(table(spark, sf_dir, "documents"))

"""Approximate nearest neighbours by cosine: a hierarchical navigable small-world graph for each shard.

Distinct vectors are dealt by hash into shards of about SHARD nodes. A task builds a shard's graph and stores it as flat
arrays: for each layer one matrix of neighbours, -1 where there are fewer. Nodes stand by falling level, so that a layer's
nodes are the first ones and a layer is built over the finished layers above it. Nodes go in by batches; a batch is searched
in lockstep, all its beams at once, and links to what it found and to its own members by the rule that a neighbour must be
nearer to the node than to any neighbour already taken. Queries are packed into blocks, each block meets each shard, and a
window merges the shards' results by exact cosine.

Rows whose vector is null, empty, zero or has null or non-finite components take no part, nor do rows without vec_id, which
can't be named. Repeated rows count once. Equal vectors are one node that remembers its smallest ids. Vectors are only
compared with those of the same number of components, and never with one of their own vec_id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import batch_rows, table, written

#: Nodes of a shard, queries of a block.
SHARD, BLOCK = 8192, 512
#: Links of a node in the upper layers (twice as many in the lowest), beam widths of building and of search.
LINKS, BUILD_BEAM, SEARCH_BEAM = 16, 64, 128
#: Nodes that go into a layer at once, and candidates of a beam that are expanded at once.
BATCH, STEP = 256, 4

_GRAPHS = "shard int, dim int, vectors binary, members array<array<long>>, layers array<binary>, sizes array<int>"
_BLOCKS = "block int, dim int, ids binary, vectors binary"


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1 in single precision: what graphs are navigated by."""
    return (vectors / np.linalg.norm(vectors, axis=1)[:, None]).astype(np.float32)


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Each vector times a power of two that brings its largest component near 1: an exact step that no square overflows after."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1))[1][:, None])


def beam_search(units: np.ndarray, links: np.ndarray, queries: np.ndarray, start: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, likeness) of the `width` best nodes that each query's beam reaches from its start, best first; -1 where fewer.

    All beams advance together: in each round every query expands its STEP best nodes not expanded yet.
    """
    q, n = len(queries), len(links)
    nodes, like = np.full((q, width), -1, np.int32), np.full((q, width), -np.inf, np.float32)
    fresh = np.zeros((q, width), bool)
    nodes[:, 0], fresh[:, 0] = start, True
    like[:, 0] = np.einsum("ij,ij->i", queries, units[start])
    seen = np.zeros((q, n), bool)
    seen[np.arange(q), start] = True
    claim = np.zeros((q, n), np.int16)
    live = np.arange(q)
    step = min(STEP, width)
    while len(live):
        open_like = np.where(fresh[live], like[live], -np.inf)
        pick = np.argpartition(-open_like, step - 1, axis=1)[:, :step] if step < width else np.tile(np.arange(width), (len(live), 1))
        real = np.take_along_axis(open_like, pick, 1) > -np.inf
        going = real.any(1)
        live, pick, real = live[going], pick[going], real[going]
        if not len(live):
            break
        rows = live[:, None]
        fresh[rows, pick] = False
        near = np.where(real[:, :, None], links[nodes[rows, pick]], -1).reshape(len(live), -1)
        new = near >= 0
        safe = np.where(new, near, 0)
        new &= ~seen[rows, safe]
        order = np.broadcast_to(np.arange(near.shape[1], dtype=np.int16), near.shape)
        r, c = np.nonzero(new)
        claim[live[r], near[r, c]] = order[r, c]
        first = claim[live[r], near[r, c]] == order[r, c]  # of a node that several expansions reach one counts
        r, c = r[first], c[first]
        found = near[r, c]
        seen[live[r], found] = True
        sims = np.einsum("ij,ij->i", queries[live[r]], units[found])
        better = sims > like[live[r], -1]
        r, found, sims = r[better], found[better], sims[better]
        if not len(r):
            continue
        count = np.bincount(r, minlength=len(live))
        slot = np.arange(len(r)) - np.repeat(np.cumsum(count) - count, count)
        more = int(count.max())
        all_nodes = np.concatenate([nodes[live], np.full((len(live), more), -1, np.int32)], 1)
        all_like = np.concatenate([like[live], np.full((len(live), more), -np.inf, np.float32)], 1)
        all_fresh = np.concatenate([fresh[live], np.zeros((len(live), more), bool)], 1)
        all_nodes[r, width + slot], all_like[r, width + slot], all_fresh[r, width + slot] = found, sims, True
        best = np.argsort(-all_like, axis=1, kind="stable")[:, :width]
        nodes[live], like[live], fresh[live] = (np.take_along_axis(a, best, 1) for a in (all_nodes, all_like, all_fresh))
    return nodes, like


def chosen(units: np.ndarray, candidates: np.ndarray, like: np.ndarray, links: int) -> np.ndarray:
    """Up to `links` neighbours from each row of candidates, best first: those nearer to the node than to one taken before.

    Places that stay free go to the best of the others.
    """
    rows, width = candidates.shape
    own = units[np.where(candidates >= 0, candidates, 0)]
    between = own @ own.transpose(0, 2, 1)
    taken = np.zeros((rows, width), bool)
    count = np.zeros(rows, np.int32)
    closest = np.full((rows, width), -np.inf, np.float32)
    for j in range(width):
        take = (candidates[:, j] >= 0) & (count < links) & (closest[:, j] < like[:, j])
        taken[:, j] = take
        count += take
        closest = np.where(take[:, None], np.maximum(closest, between[:, j]), closest)
    rank = np.where(candidates < 0, 2 * width, np.where(taken, 0, width) + np.arange(width))
    best = np.argsort(rank, axis=1, kind="stable")[:, :links]
    out = np.full((rows, links), -1, np.int32)
    out[:, : best.shape[1]] = np.take_along_axis(candidates, best, 1)
    return out


def _distinct_sorted(nodes: np.ndarray, like: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The best `width` of each row, each node once."""
    order = np.argsort(-like, axis=1, kind="stable")
    nodes, like = np.take_along_axis(nodes, order, 1), np.take_along_axis(like, order, 1)
    by_node = np.argsort(nodes, axis=1, kind="stable")
    again = np.zeros(nodes.shape, bool)
    ranked = np.take_along_axis(nodes, by_node, 1)
    np.put_along_axis(again, by_node, np.concatenate([np.zeros((len(nodes), 1), bool), ranked[:, 1:] == ranked[:, :-1]], 1), 1)
    like = np.where(again | (nodes < 0), -np.inf, like)
    order = np.argsort(-like, axis=1, kind="stable")[:, :width]
    nodes, like = np.take_along_axis(nodes, order, 1), np.take_along_axis(like, order, 1)
    return np.where(like > -np.inf, nodes, -1), like


class Graph:
    """A shard's graph: links[0] is the lowest layer; layer k holds the first len(links[k]) nodes."""

    def __init__(self, units: np.ndarray, layers: list[np.ndarray]):
        self.units, self.layers = units, layers

    def enter(self, queries: np.ndarray, above: int) -> np.ndarray:
        """The node nearest to each query that a greedy walk down the layers from the top to layer `above` reaches."""
        start = np.zeros(len(queries), np.int64)
        for links in reversed(self.layers[above:]):
            start = beam_search(self.units, links, queries, start, 1)[0][:, 0].astype(np.int64)
        return start

    def search(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        return beam_search(self.units, self.layers[0], queries, self.enter(queries, 1), min(width, len(self.units)))

    @classmethod
    def built(cls, units: np.ndarray, sizes: list[int], links: int = LINKS, width: int = BUILD_BEAM) -> Graph:
        """sizes: nodes of each layer, the lowest first; the first nodes are those of the upper layers."""
        graph = cls(units, [np.empty((0, links), np.int32)] * len(sizes))
        for k in reversed(range(len(sizes))):
            graph._layer(k, sizes[k], 2 * links if k == 0 else links, width)
        return graph

    def _layer(self, k: int, size: int, links: int, width: int) -> None:
        layer = np.full((size, links), -1, np.int32)
        self.layers[k] = layer
        above, done = len(self.layers[k + 1]) if k + 1 < len(self.layers) else size, 1
        while done < size:
            end = min(size, done + min(BATCH, done))
            new = self.units[done:end]
            start = self.enter(new, k + 1) if done >= above else np.zeros(len(new), np.int64)  # a walk may end at any node above
            nodes, like = beam_search(self.units, layer[:done], new, start, min(width, done))
            among = new @ new.T
            np.fill_diagonal(among, -np.inf)
            peers = np.argsort(-among, axis=1, kind="stable")[:, : min(links, len(new))]
            nodes, like = np.concatenate([nodes, peers + done], 1).astype(np.int32), np.concatenate([like, np.take_along_axis(among, peers, 1)], 1)
            nodes, like = _distinct_sorted(nodes, like, min(width, nodes.shape[1]))
            layer[done:end] = chosen(self.units, nodes, like, links)
            self._back(layer, done, end)
            done = end

    def _back(self, layer: np.ndarray, done: int, end: int) -> None:
        """Links from the neighbours of the nodes [done, end) back to them; full lists are chosen anew."""
        links = layer.shape[1]
        source = np.repeat(np.arange(done, end), links)
        target = layer[done:end].ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        touched, count = np.unique(target, return_counts=True)
        slot = np.arange(len(target)) - np.repeat(np.cumsum(count) - count, count)
        more = np.full((len(touched), int(count.max(initial=0))), -1, np.int32)
        more[np.repeat(np.arange(len(touched)), count), slot] = source
        for a in range(0, len(touched), BATCH):
            at = touched[a : a + BATCH]
            nodes = np.concatenate([layer[at], more[a : a + BATCH]], 1)
            like = np.where(nodes >= 0, np.einsum("ij,ikj->ik", self.units[at], self.units[np.where(nodes >= 0, nodes, 0)]), -np.inf)
            nodes, like = _distinct_sorted(nodes, like, min(2 * links, nodes.shape[1]))
            layer[at] = chosen(self.units, nodes, like, links)


def usable(rows: DataFrame) -> DataFrame:
    """vec_id, v (doubles) of the rows that take part, each once."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    return rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~bad & some).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")).distinct()


def nodes_of(own: DataFrame, ids: int) -> DataFrame:
    """v and members: the `ids` smallest ids of each distinct vector. Spark limits the rows of a vector before it shuffles them."""
    few = own.withColumn("n", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).where(F.col("n") <= ids)
    return few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("members"))


def shard_graphs(nodes: DataFrame, shards: int, links: int = LINKS, width: int = BUILD_BEAM) -> DataFrame:
    """One row a shard and number of components: original vectors, members and the layers' neighbours as flat arrays."""

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        v = np.array(rows["v"].tolist(), np.float64)
        # The level of a node comes from its hash; sizes of layers fall by the number of links.
        order = np.argsort(rows["h"].to_numpy(), kind="stable")
        sizes = [len(v)]
        while sizes[-1] > links * 2:
            sizes.append(sizes[-1] // links)
        v = v[order]
        graph = Graph.built(unit(scaled(v)), sizes, links, width)
        members = [rows["members"].iloc[i] for i in order]
        return pd.DataFrame([(int(rows["shard"].iloc[0]), v.shape[1], v.tobytes(), members, [x.tobytes() for x in graph.layers], sizes)], columns=[c.split()[0] for c in _GRAPHS.split(", ")])

    h = F.xxhash64("v")
    dealt = nodes.select("v", "members", F.size("v").alias("dim"), F.pmod(h, F.lit(shards)).cast("int").alias("shard"), F.xxhash64(h, F.lit(1)).alias("h"))
    return dealt.groupBy("dim", "shard").applyInPandas(build, _GRAPHS)


def query_blocks(queries: DataFrame, count: int, size: int = BLOCK) -> DataFrame:
    """Queries packed into blocks of about `size`."""

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        v = np.array(rows["v"].tolist(), np.float64)
        return pd.DataFrame([(int(rows["block"].iloc[0]), v.shape[1], rows["vec_id"].to_numpy(np.int64).tobytes(), v.tobytes())], columns=[c.split()[0] for c in _BLOCKS.split(", ")])

    block = F.pmod(F.xxhash64("vec_id", "v"), F.lit(max(1, count // size))).cast("int").alias("block")
    return queries.select("vec_id", "v", F.size("v").alias("dim"), block).groupBy("dim", "block").applyInPandas(pack, _BLOCKS)


def searched(blocks: DataFrame, graphs: DataFrame, shards: int, k: int, width: int) -> DataFrame:
    """query (block and place), query_id, vec_id, score: the k best of each shard, by the cosine in double precision."""

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                exact = scaled(np.frombuffer(row.g_vectors, np.float64).reshape(-1, row.dim))
                layers = [np.frombuffer(x, np.int32).reshape(n, -1) for x, n in zip(row.layers, row.sizes)]
                ids, queries = np.frombuffer(row.ids, np.int64), scaled(np.frombuffer(row.vectors, np.float64).reshape(-1, row.dim))
                found, _ = Graph(unit(exact), layers).search(unit(queries), width)
                own, lengths = np.sqrt((queries**2).sum(1)), np.sqrt((exact**2).sum(1))
                out = []
                for i, nodes in enumerate(found):
                    nodes = nodes[nodes >= 0]
                    scores = exact[nodes] @ queries[i] / (own[i] * lengths[nodes])
                    pairs = sorted((-s, int(m)) for s, n in zip(scores.tolist(), nodes.tolist()) for m in row.members[n] if m != ids[i])[:k]
                    out += [(row.dim, row.block, i, int(ids[i]), m, -s) for s, m in pairs]
                yield pd.DataFrame(out, columns=["dim", "block", "place", "query_id", "vec_id", "score"])

    # Spark doesn't know that a block stands once for each shard and would broadcast them all from the driver.
    dealt = blocks.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).hint("merge")
    pairs = dealt.join(graphs.withColumnRenamed("vectors", "g_vectors"), ["dim", "shard"])
    return pairs.mapInPandas(search, "dim int, block int, place int, query_id long, vec_id long, score double")


def nearest(rows: DataFrame, every: int, k: int, shard: int = SHARD, width: int = SEARCH_BEAM, build_width: int = BUILD_BEAM, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row whose vec_id `every` divides, ties by smaller vec_id.

    rows: vec_id, embedding. Ids of a node beyond the k + 1 smallest can't be among a query's k nearest.
    """
    spark = rows.sparkSession
    own = written(usable(rows))
    nodes = written(nodes_of(own, k + 1))
    shards = max(1, -(-nodes.count() // shard))
    graphs = written(shard_graphs(nodes, shards, width=build_width))
    queries = own.where(F.col("vec_id") % every == 0)
    blocks = written(query_blocks(queries, queries.count(), block))
    with batch_rows(spark, 4):
        found = searched(blocks, graphs, shards, k, width)
        order = Window.partitionBy("dim", "block", "place").orderBy(F.desc("score"), "vec_id")
        best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        return written(best.select("query_id", "rank", "vec_id", "score"))


def op11_hnsw_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest rows found for every row of embeddings whose vec_id 50 divides."""
    return nearest(table(spark, sf_dir, "embeddings"), 50, 5)

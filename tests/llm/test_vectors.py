"""Nearest neighbours and hard negatives against brute force over all pairs."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest

from relaylens.llm import hnsw, lemp

COLUMNS = "vec_id long, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")


def vectors(n, dim=8, seed=1, labels=4):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, dim)).astype(np.float32) * rng.uniform(0.2, 3, size=(n, 1)).astype(np.float32)
    return [(i, [float(x) for x in v[i]], int(rng.integers(labels))) for i in range(n)]


ODD = [(5000, None, 1), (5001, [], 1), (5002, [0.0] * 8, 1), (5003, [1.0, NAN, *[0.0] * 6], 2), (5004, [INF] * 8, 2), (5005, [None, *[1.0] * 7], 2), (None, [1.0] * 8, 1), (5050, None, None), (5100, [0.0] * 8, 2), (5150, [1.0, 2.0], None), (5200, [1.0, 2.0], 1), (5250, [2.0, 4.5], 1), (5300, [3.0], 0)]


def usable(rows):
    return [(i, np.array(v, np.float64), k) for i, v, k in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]


def brute_nearest(rows, every, k):
    own = {(i, tuple(v)): v for i, v, _ in usable(rows) if np.any(v)}
    out = {}
    for (i, t), q in own.items():
        if i % every == 0:
            scored = sorted((-float(q @ v / (np.sqrt(q @ q) * np.sqrt(v @ v))), j) for (j, _), v in own.items() if j != i and len(v) == len(q))
            out[i] = scored[:k]
    return out


def recall(got, want):
    found = defaultdict(list)
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        found[r.query_id].append((r.vec_id, r.score, r.rank))
    hit = total = 0
    for q, best in want.items():
        rows = found.pop(q, [])
        assert len(rows) == len(best) and [r[2] for r in rows] == list(range(1, len(best) + 1))
        assert all(a[1] > b[1] or a[1] == b[1] and a[0] < b[0] for a, b in zip(rows, rows[1:]))
        hit += len({r[0] for r in rows} & {j for _, j in best})
        total += len(best)
    assert not found
    return hit / max(total, 1)


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_of_the_query_over_its_whole_table(spark, sf):
    where = f"/root/testdata/{sf}"
    rows = [tuple(r) for r in spark.read.parquet(f"{where}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = hnsw.op11_hnsw_neighbours(spark, where).collect()
    want = brute_nearest(rows, 50, 5)
    assert recall(got, want) >= 0.95
    known = {(q, j): -s for q, best in want.items() for s, j in best}
    assert all(abs(r.score - known.get((r.query_id, r.vec_id), r.score)) < 1e-12 for r in got)


def test_neighbours_over_many_shards_copies_and_odd_rows(spark):
    rows = vectors(1500)
    copies = [(2000 + i, rows[7][1], 0) for i in range(700)]
    rows = [*rows, *copies, *ODD, rows[50], rows[100]]
    table = spark.createDataFrame(rows, COLUMNS).selectExpr("*", "1 as v", "'x' as members", "2 as rank", "3 as dim")
    got = hnsw.nearest(table, 50, 5, shard=256, block=16).collect()
    want = brute_nearest(rows, 50, 5)
    assert recall(got, want) >= 0.95
    best = {r.query_id: r for r in got if r.rank == 1}
    assert best[5200].vec_id == 5150 and best[5250].vec_id == 5150 and 5100 not in best and 5300 not in best
    assert [r.vec_id for r in sorted((r for r in got if r.query_id == 2050), key=lambda r: r.rank)] == [7, 2000, 2001, 2002, 2003]


def test_blocks_dealt_to_shards_are_not_broadcast(spark, capsys):
    own = hnsw.written(hnsw.usable(spark.createDataFrame(vectors(600), COLUMNS)))
    graphs = hnsw.written(hnsw.shard_graphs(hnsw.nodes_of(own, 6), 4))
    found = hnsw.searched(hnsw.written(hnsw.query_blocks(own.where("vec_id % 50 = 0"), 12, 4)), graphs, 4, 5, 16)
    assert {r.query_id for r in found.collect()} == set(range(0, 600, 50))
    found.explain()
    assert "Broadcast" not in capsys.readouterr().out


def test_neighbours_of_nothing_and_of_one(spark):
    none = spark.createDataFrame([], COLUMNS)
    assert hnsw.nearest(none, 50, 5).count() == 0
    assert hnsw.nearest(spark.createDataFrame([(0, [1.0, 2.0], 1)], COLUMNS), 50, 5).count() == 0
    huge = spark.createDataFrame([(0, [1e200, 1e200]), (1, [1e-200, 0.0]), (2, [-3.0, -3.0])], "vec_id long, embedding array<double>")
    assert [(r.vec_id, round(r.score, 9)) for r in sorted(hnsw.nearest(huge, 50, 5).collect(), key=lambda r: r.rank)] == [(1, 0.707106781), (2, -1.0)]


def brute_negatives(rows, every=100):
    own = {(i, tuple(np.floor(256 * v).astype(int).tolist()), (k + 1) % 10 if i % 7 == 0 else k) for i, v, k in usable(rows) if k is not None}
    out = []
    for i, a, k in own:
        if i % every:
            continue
        scored = [(-sum(x * y for x, y in zip(a, b)), j, m) for j, b, m in own if j != i and len(a) == len(b)]
        for p, j, _ in sorted(x for x in scored if x[2] == k)[:5]:
            fits = sorted(x for x in scored if x[2] != k and 30 * -p <= 100 * -x[0] <= 90 * -p)[:10]
            out += [(i, j, n + 1, m, -p, -s) for n, (s, m, _) in enumerate(fits)]
    return sorted(out)


def plain(frame):
    return sorted((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in frame.collect())


def test_negatives_of_the_query_over_its_whole_table(spark):
    where = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{where}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert plain(lemp.op13_lemp_negatives(spark, where)) == brute_negatives(rows)


@pytest.mark.parametrize("bucket,block", [(16, 4), (lemp.BUCKET, lemp.BLOCK)])
def test_negatives_over_small_buckets_ties_and_odd_rows(spark, bucket, block):
    rows = vectors(900, dim=8)
    rows = [*rows, *[(2000 + i, rows[3][1], i % 3) for i in range(60)], *ODD, rows[100], rows[200], (3000, [0.0] * 8, 1), (3001, [5e3] * 8, 2)]
    table = lemp.shifted_labels(spark.createDataFrame(rows, COLUMNS).selectExpr("*", "1 as v", "2 as block", "3 as rank"))
    got = lemp.hard_negatives(table, bucket=bucket, block=block)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert plain(got) == brute_negatives(rows)


def test_negatives_of_nothing(spark):
    none = spark.createDataFrame([], COLUMNS)
    assert lemp.hard_negatives(none).count() == 0
    assert lemp.hard_negatives(spark.createDataFrame([(0, [1.0], 1), (1, [1.0], 1)], COLUMNS)).count() == 0


def test_coordinate_ranges_leave_out_rows_but_no_result():
    """Among vectors in groups the ranges prune most rows, and what they leave holds all that reach the score."""
    import pandas as pd

    rng = random.Random(2)
    centres = [rng.sample([900, -900, 900, *[0] * 9], 12) for _ in range(30)]
    v = np.array([[x + rng.randint(-40, 40) for x in centres[i % 30]] for i in range(600)])
    made = lemp._bucket(pd.DataFrame({"vec_id": range(600), "label": 1, "dim": 12, "v": list(v)}), "b")
    bucket = lemp.Bucket(1, *made[3:], 12)
    left = []
    for a in v[:60]:
        length = math.sqrt(int(a @ a))
        scores = v @ a
        least = int(np.sort(scores)[-10])
        at = bucket.candidates(a / length, length, np.argsort(-np.abs(a))[: lemp.FOCUS], least)
        assert set(np.flatnonzero(scores >= least)) <= set(at)
        assert (bucket.scores(a, at) == scores[at]).all()
        left.append(len(at))
    assert sum(left) / len(left) < 200

"""PartEnum join, winnowing and bottom-k sketches against brute force."""


import hashlib
import random
import re
import struct

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from relaylens.llm import bottomk, partenum, winnow

DOCS = "doc_id long, text string"


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def corpus(seed, groups=12, copies=6):
    """Bases of several lengths, each with copies that have more and more words replaced, and a passage that all share."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghij", k=4))
    passage = [word() for _ in range(30)]
    rows, i = [], 0
    for g in range(groups):
        base = [word() for _ in range(rng.choice([3, 6, 9, 15, 25, 60, 150, 400]))]
        if g % 3 == 0:
            base = base + passage
        for c in range(copies):
            w = list(base)
            for _ in range(c * max(1, len(w) // 60)):
                w[rng.randrange(len(w))] = word()
            rows.append((i, " ".join(w)))
            i += 1
    return [*rows, (i, None), (i + 1, ""), (i + 2, " \t\n"), (i + 3, rows[5][1].upper()), (i + 4, "one"), (i + 5, "ONE")]


def brute_components(rows):
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_equal_brute_force(spark, seed):
    rows = corpus(seed)
    got = partenum.near_components(spark.createDataFrame(rows, DOCS)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows)


def test_empty_table_null_ids_and_repeats(spark):
    assert partenum.near_components(spark.createDataFrame([], DOCS)).count() == 0
    rows = [(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (4, "q")]
    got = sorted(partenum.near_components(spark.createDataFrame(rows, DOCS)).collect(), key=str)
    assert sorted((str(r.doc_id), r.component_id) for r in got) == [("3", 3), ("3", 3), ("4", 4), ("None", 3)]


def test_components_of_a_table_whose_rows_are_all_repeated(spark):
    rows = corpus(1)
    got = partenum.near_components(spark.createDataFrame(rows + rows, DOCS)).collect()
    assert len(got) == 2 * len(rows) and {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows)


def test_signatures_with_repeated_members_keep_all_links(spark, monkeypatch):
    """{1, 2, 4} and {1, 3, 4} agree in number, first, last and centre; with each member twice, all else cancels out."""
    shingle = np.arange(100, dtype=np.uint64)
    sets = spark.createDataFrame([(i, 100, 100, partenum._counts(shingle), bytearray(shingle.tobytes())) for i in (1, 2, 3, 4)], "node long, n int, room int, counts binary, shingles binary")
    sigs = spark.createDataFrame([(sig, i, 100, 100) for sig, members in ((7, (1, 2, 4)), (8, (1, 3, 4))) for i in members * 2], "sig long, node long, n int, room int")
    monkeypatch.setattr(partenum, "signature_rows", lambda _: sigs)
    assert {r.node: r.component for r in partenum.linked(sets).collect()} == dict.fromkeys((1, 2, 3, 4), 1)


def test_a_set_is_one_row_and_two_texts_of_one_id_are_two(spark):
    base = [f"w{i}" for i in range(40)]
    texts = [" ".join(base), " ".join([*base, "x"]), " ".join([*base, "x", "y"])]
    docs = spark.createDataFrame([(1, texts[0]), (1, texts[0]), (1, texts[1]), (2, texts[2]), (2, texts[2])], DOCS)
    keys = partenum.set_keys(docs)
    classes = keys.groupBy("set_key").agg(F.min("doc_id").alias("node"), F.max("n_shingles").alias("n"), F.max("tag").alias("tag"))
    assert sorted(r.node for r in partenum.near_sets(docs, classes, 100).collect()) == [1, 1, 2]


def family(seed, size, words_, edits, rounds=1):
    """Sets round the threshold: edits of one text, and in further rounds edits of texts made before."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghij", k=5))
    made = [[word() for _ in range(words_)]]
    for k in range(size - 1):
        w = list(made[0] if k < size / rounds else rng.choice(made))
        for _ in range(rng.randint(*edits)):
            at = rng.randrange(len(w))
            w[at : at + rng.choice([0, 1, 1, 2])] = [word()] * rng.choice([0, 1, 1])
        made.append(w)
    order = list(range(size))
    rng.shuffle(order)
    return [(i, " ".join(w)) for i, w in zip(order, made)]


@pytest.mark.parametrize("seed,size,words_,edits,rounds", [(1, 320, 80, (2, 8), 1), (2, 320, 60, (1, 5), 3), (3, 200, 500, (10, 45), 3)])
def test_families_round_the_threshold_equal_brute_force(spark, seed, size, words_, edits, rounds):
    rows = family(seed, size, words_, edits, rounds)
    expected = brute_components(rows)
    assert 3 < len({c for _, c in expected.values()}) < size
    got = partenum.near_components(spark.createDataFrame(rows, DOCS)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == expected


def test_near_sets_share_an_early_edit_of_any_pivot():
    """The lemma of the last round: any pivot, any order; one of both sets isn't near the pivot."""
    rng = np.random.default_rng(8)
    seen = 0
    for _ in range(4000):
        n = int(rng.integers(4, 60))
        pivot = set(range(n))
        x = (pivot - set(rng.choice(n, int(rng.integers(0, n // 2 + 1)), False).tolist())) | set(range(1000, 1000 + int(rng.integers(0, n // 2))))
        y = set(x)
        for _ in range(int(rng.integers(0, max(2, n // 4)))):
            y ^= {int(rng.choice([*range(n), *range(1000, 1020)]))}
        if not x or not y or x == y:
            continue
        near = lambda a, b: 4 * len(a & b) >= 3 * len(a | b)
        order = {e: k for k, e in enumerate(rng.permutation(2000).tolist())}
        if not near(x, y) or near(y, pivot):
            continue
        seen += 1
        early = lambda s, k: set(sorted(s ^ pivot, key=order.get)[:k])  # noqa: B023, E731
        a, b = (partenum.prefix_sizes(len(s ^ pivot), len(s), 10**6, n) for s in (x, y))
        first = early(x, a[1]) & early(y, b[0])
        assert first, (x, y, n)
        shared = min(first, key=order.get)
        rest = [len(s ^ pivot) - sorted(s ^ pivot, key=order.get).index(shared) for s in (x, y)]
        assert 7 * (len(x ^ pivot) + len(y ^ pivot) - 2 * min(rest)) <= len(x) + len(y)
        if not near(x, pivot):
            assert early(x, a[1]) & early(y, b[1])
    assert seen > 200


def two_templates(spark, n, seed=3):
    """(sets, family): 12 sets of one template, n of a second one, and a long set that holds all own parts of these.

    All sets of the second template share 150 shingles, 20 are common to both, and each has 34 of its own: no two are near.
    """
    rng = np.random.default_rng(seed)
    new = lambda k: rng.integers(0, 2**63, k, dtype=np.uint64)
    both, first, second = new(20), new(160), new(142)
    own = [new(34) for _ in range(n)]
    sets = [np.concatenate([both, first, new(20)]) for _ in range(12)] + [np.concatenate([both, second, x]) for x in own] + [np.concatenate([both, second, *own])]
    rows = [(i, len(s), 10**6, b"", np.sort(s).tobytes()) for i, s in enumerate(sets)]
    return spark.createDataFrame(rows, "node long, n int, room int, counts binary, shingles binary"), spark.createDataFrame([(i, 0, i) for i in range(1, len(sets))], "node long, pivot long, component long")


def test_two_templates_meet_no_more_than_in_proportion(spark):
    meetings = {}
    for n in (100, 200, 400):
        sets, family = two_templates(spark, n)
        early = partenum.early_edits(partenum.edited(family, sets))
        per = early.groupBy("pivot", "edit").agg(F.count("*").alias("all"), F.count_if("first_half").alias("half"))
        meetings[n] = int(per.agg(F.coalesce(F.sum(F.col("all") * F.col("half")), F.lit(0))).first()[0])
        assert partenum.edit_pairs(early).count() <= n
    assert meetings[400] <= 5 * max(meetings[100], 200)


def test_early_edits_keep_each_near_pair(spark):
    """Sets of a pivot with few to many edits, some in common: each near pair of which one isn't near the pivot is found."""
    rng = np.random.default_rng(8)
    pool = rng.integers(0, 2**63, 4000, dtype=np.uint64)
    pivot = pool[:120]
    sets = {0: set(pivot.tolist())}
    for i in range(1, 160):
        base = sets[rng.integers(0, i)] if i % 3 else sets[0]
        s, cut = list(base), int(rng.integers(1, 40))
        rng.shuffle(s)
        sets[i] = {*s[cut:], *rng.choice(pool[: 200 + 20 * (i % 9)], int(rng.integers(1, 40))).tolist()}
    near = lambda x, y: 4 * len(x & y) >= 3 * len(x | y)
    rows = [(i, len(s), 10**6, b"", np.sort(np.array(list(s), np.uint64)).tobytes()) for i, s in sets.items()]
    frame = spark.createDataFrame(rows, "node long, n int, room int, counts binary, shingles binary")
    family = spark.createDataFrame([(i, 0, i) for i in range(1, 160)], "node long, pivot long, component long")
    got = {(r.src, r.dst) for r in partenum.edit_pairs(partenum.early_edits(partenum.edited(family, frame))).collect()}
    want = {(i, j) for i in sets for j in sets if 0 < i < j and near(sets[i], sets[j]) and not (near(sets[i], sets[0]) and near(sets[j], sets[0]))}
    assert want and want <= got


def test_near_sets_share_a_signature():
    """All pairs of sets at the bound, over many sizes, share a signature: the lemma that the join rests on.

    In the larger one's band they share more than both may leave out.
    """
    rng = np.random.default_rng(5)
    spares = 0
    for _ in range(600):
        n = int(rng.integers(3, rng.choice([400, 1500])))
        a = rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        most = 2 * n // 7 + 2
        out, more = int(rng.integers(0, most)), int(rng.integers(0, most))
        b = np.concatenate([a[min(out, n - 1) :], rng.integers(0, 2**63, more, dtype=np.uint64)])
        a, b = np.unique(a), np.unique(b)
        both = len(np.intersect1d(a, b))
        if 4 * both < 3 * (len(a) + len(b) - both) or np.array_equal(a, b):
            continue
        bands = partenum._bands(max(len(a), len(b)))
        assert np.intersect1d(partenum.signatures(a, bands), partenum.signatures(b, bands)).size
        x, y = ({band: (sigs, spare) for band, sigs, spare in partenum._by_band(s, bands)} for s in (a, b))
        for band in x.keys() & y.keys():
            assert len(np.intersect1d(x[band][0], y[band][0])) > x[band][1] + y[band][1]
            spares += x[band][1] > 0
    assert spares > 50


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))


def brute_leaks(rows, items):
    windows = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[k : k + 10]), set()).add(str(i))
    out = {}
    for d, t in rows:
        w, hit, found = words(t), set(), set()
        for n in {len(k) for k in windows}:
            for p in range(len(w) - n + 1):
                if ids := windows.get(tuple(w[p : p + n])):
                    found |= ids
                    hit |= set(range(p, p + n))
        out[d] = (len(w), len(hit), sorted(found))
    return out


def test_leaks_equal_brute_force(spark):
    rng = random.Random(4)
    word = lambda: rng.choice(["ab", "cd", "ef", "Gh", "é1", "x"])  # noqa: E731 few words: many repeats and ties
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 4, 9, 10, 11, 30])))) for i in range(12)] + [(50, None), (51, "..."), (10, "same words"), (11, "Same, words!")]
    rows = []
    for d in range(40):
        w = [word() + str(rng.randrange(3)) for _ in range(rng.choice([0, 5, 40, 300]))]
        if d % 2:
            w[3:3] = items[d % 12][1].split()
        rows.append((d, "-".join(w)))
    rows += [(100, None), (101, ""), (102, "same words")]
    got = winnow.contamination(spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in got} == brute_leaks(rows, items)


def test_leaks_of_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "a b")], DOCS), spark.createDataFrame([], "item_id long, text string")
    assert [r.n_hit for r in winnow.contamination(docs, items).collect()] == [0, 0, 0]
    items = spark.createDataFrame([(5, "A b")], "item_id long, text string")
    assert [r.n_hit for r in winnow.contamination(docs, items).collect()] == [2, 2, 2]
    assert winnow.contamination(docs.where("false"), items).count() == 0


def test_sketches(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=5))
    base = [word() for _ in range(2000)]
    texts = {1: " ".join(base), 2: " ".join(base[:1500] + [word() for _ in range(500)]), 3: "few words", 4: "", 5: " ".join(base[:1000])}
    df = bottomk.with_sketch(spark.createDataFrame([*texts.items(), (6, None)], DOCS), "text", "s")
    s = {r.doc_id: r.s for r in df.collect()}
    assert s[4] == s[6] == [] and len(s[3]) == 1 and len(s[1]) == bottomk.K
    pairs = df.selectExpr("doc_id a", "s x").crossJoin(df.selectExpr("doc_id b", "s y"))
    x, y = bottomk.F.col("x"), bottomk.F.col("y")
    got = {(r.a, r.b): r for r in pairs.select("a", "b", bottomk.resemblance(x, y).alias("j"), bottomk.containment(x, y).alias("c"), bottomk.distinct_shingles(x).alias("n")).collect()}
    for a in texts:
        assert got[a, a].j == 1.0
        for b in texts:
            p, q = shingles(texts[a]), shingles(texts[b])
            assert got[a, b].j == pytest.approx(len(p & q) / len(p | q) if p | q else 1.0, abs=0.15)
            assert got[a, b].c == pytest.approx(len(p & q) / len(p) if p else 1.0, abs=0.2)
    assert got[1, 1].n == pytest.approx(1996, rel=0.3) and got[3, 3].n == 1


def test_sketches_merge_in_any_order(spark):
    df = bottomk.with_sketch(spark.createDataFrame([(i, f"w{i} x y z q r s{i % 7} t u v" * 30) for i in range(20)], DOCS), "text", "s").withColumn("g", bottomk.F.col("doc_id") % 2)
    merged = {r.g: r.s for r in bottomk.merge_by(df, ["g"], "s").collect()}
    for g, s in merged.items():
        every = sorted({h for r in df.where(f"g = {g}").collect() for h in r.s})
        assert s == every[: bottomk.K]


def test_edits_of_odd_documents(spark):
    rows = [(2, "abcdefgh"), (5, None), (7, ""), (9, "xyz" * 9), (None, "nnnn"), (9, "xyz" * 9)]
    got = bottomk.edited_pairs(spark.createDataFrame(rows, DOCS)).collect()
    order = [(None, "nnnn"), (2, "abcdefgh"), (5, ""), (7, ""), (9, "xyz" * 9)]
    want = {}
    for k, (d, t) in enumerate(order):
        q = len(t) // 4
        want[d] = t[: len(t) - q] + order[(k + 1) % len(order)][1][:q]
    assert len(got) == len(rows) and {r.doc_id: r.edited for r in got} == want
    assert bottomk.edited_pairs(spark.createDataFrame([(1, "alone in here")], DOCS)).collect()[0].edited == "alone in halo"


def long_hash(h, x):
    return xxhash.xxh64_intdigest(struct.pack("<q", x), h)


def signed(h):
    return h - 2**64 if h >= 2**63 else h


def brute_sketch(text):
    """The 128 least hashes of all 5-word shingles, by another library."""
    w = [signed(xxhash.xxh64_intdigest(x.encode(), 42)) for x in re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())]
    runs = [w[i : i + 5] for i in range(len(w) - 4)] or ([w] if w else [])
    hashes = set()
    for run in runs:
        h = 42
        for x in run:
            h = long_hash(h, x)
        hashes.add(signed(h))
    return sorted(hashes)[:128]


def brute_likeness(a, b):
    union = sorted({*a, *b})[:128]
    return 1.0 if not a and not b else len({*a} & {*b} & {*union}) / len(union)


def test_fingerprints_equal_brute_force(spark, tmp_path):
    rng = random.Random(9)
    texts = [" ".join("".join(rng.choices("abcdé", k=3)) for _ in range(rng.choice([0, 1, 4, 5, 6, 30, 133, 400]))) for _ in range(24)]
    rows = [*enumerate(texts), (30, None), (31, ""), (32, " \t\n "), (33, texts[7]), (34, "x" * 100_000), (35, "A b C d e"), (36, " ".join(f"w{i}" for i in range(30_000)))]
    spark.createDataFrame([(i, t, 1.0, "k") for i, t in rows], DOCS + ", near_next double, own string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in bottomk.op3_bottom_k(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    for (i, t), (_, after) in zip(rows, [*rows[1:], rows[0]]):
        t, after = t or "", after or ""
        n = len(t) // 4
        edited = t[: len(t) - n] + after[:n]
        own, other, following = (brute_sketch(x) for x in (t, edited, after))
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == ",".join(map(str, own)) and r.edited_fingerprint == ",".join(map(str, other))
        assert r.near_edited == pytest.approx(brute_likeness(own, other)) and r.near_next == pytest.approx(brute_likeness(own, following))


def test_fingerprints_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    assert bottomk.op3_bottom_k(spark, str(tmp_path)).count() == 0

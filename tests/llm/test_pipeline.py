"""The pipeline over its own small tables: each stage's decisions take effect and clean documents stay."""

import random

import corpus_pipeline
from relaylens.llm.registry import QUERIES


def word(rng):
    return "".join(rng.choices("abcdefghijklmno", k=5))


def test_all_stages(spark, tmp_path):
    rng = random.Random(1)
    text = lambda n: " ".join(word(rng) for _ in range(n)) + "."
    clean = {i: text(60) for i in range(40)}
    junk = {100 + i: " ".join(w.upper() + "!!" for w in text(40).split()) for i in range(20)}
    item = text(14)
    rows = [*clean.items(), *junk.items(), (200, clean[3]), (201, clean[4].replace(clean[4].split()[30], "zzzzz")), (202, text(20) + " " + item + " " + text(20)), (203, "12345 !!"), (204, None)]
    d = str(tmp_path)
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, int(i < 100), 0) for i, _ in rows if i < 200], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    docs = spark.read.parquet(f"{d}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, d)
        assert out.columns == docs.columns, name
    kept = {r.doc_id for r in corpus_pipeline.run(spark, d).collect()}
    assert set(clean) <= kept
    assert not kept & {*junk, 200, 201, 202, 203, 204}


def documents(spark, path, rows, labels=(), items=()):
    frame = spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, `__row` string, n_hit int")
    spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(list(items), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    frame.write.parquet(f"{path}/documents.parquet")
    return spark.read.parquet(f"{path}/documents.parquet")


def test_stages_decide_by_row_where_ids_are_null_or_repeated(spark, tmp_path):
    rng = random.Random(5)
    text = lambda n: " ".join(word(rng) for _ in range(n))
    item, twice, alone = text(14), text(50), text(50)
    leaked = f"{text(20)} {item} {text(20)}"
    rows = [(1, twice), (1, twice), (2, twice + " more"), (None, twice), (None, leaked), (3, leaked), (3, alone), (None, text(30)), (4, None), (4, None), (None, None), (5, "")]
    docs = documents(spark, str(tmp_path), rows, items=[(1, item)])
    kept = corpus_pipeline.ngram_jaccard_join(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    got = sorted((r.text or "", r.doc_id or -1) for r in kept.collect())
    assert sum(t.startswith(twice) for t, _ in got) == 1 and sum(t == leaked for t, _ in got) == 1 and sum(t == "" for t, _ in got) == 4 and len(got) == 8
    clean = corpus_pipeline.benchmark_decontamination(spark, docs, str(tmp_path))
    assert sorted((r.text or "", r.doc_id or -1) for r in clean.collect()) == sorted((t or "", i or -1) for i, t in rows if t != leaked)


def test_empty_documents_and_ids_that_name_rows(spark, tmp_path):
    docs = documents(spark, str(tmp_path), [(1, "a b c d e f"), (2, "a b c d e f")])
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), str(tmp_path)).count() == 0, name
    assert [r.doc_id for r in corpus_pipeline.ngram_jaccard_join(spark, docs, str(tmp_path)).collect()] == [1]


def test_stages_and_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "language ID", "n-gram Jaccard join", "benchmark decontamination", "byte-level BPE encoding and decoding"]
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))

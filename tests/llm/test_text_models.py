"""Quality classifier, language ID and BPE on small tables with odd rows."""

import hashlib
import random
import zlib

import public_tokenizers
import pytest
import tiktoken

from relaylens.llm import bpe, langid, quality

DOCS = "doc_id long, text string, lang string, source string"
GOOD = "The quick brown fox walks over the lazy dog and goes on. "
BAD = "BUY!! NOW!! ### *** $$$ CHEAP!! "


def docs(spark, n=60):
    rows = [(i, (GOOD if i % 3 else BAD) * (1 + i % 4), "en", "s") for i in range(n)]
    return spark.createDataFrame([*rows, (1000, None, None, None), (1001, "", "en", None), (1002, "x" * 50_000, None, "s"), (None, GOOD, None, None), (7, rows[7][1], "en", "s")], DOCS)


def labels(spark, n=60):
    return spark.createDataFrame([(i, 1 if i % 3 else 0, 0) for i in range(n)] + [(5, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int")


def test_quality_ranks_and_covers_all_rows(spark):
    d = docs(spark)
    model = quality.fit_quality(d, labels(spark))
    out = quality.score_quality(d, model, ["doc_id"]).collect()
    assert len(out) == d.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    assert {r.predicted for r in out if r.doc_id is not None and r.doc_id < 60 and r.doc_id % 3} == {1}
    assert {r.predicted for r in out if r.doc_id is not None and r.doc_id < 60 and not r.doc_id % 3} == {0}
    assert len({r.score for r in out if r.doc_id == 7}) == 1


def test_quality_without_labels_or_rows(spark):
    d = docs(spark)
    none = quality.fit_quality(d, labels(spark).where("false"))
    assert {r.predicted for r in quality.score_quality(d, none, ["doc_id"]).collect()} == {1}
    assert quality.score_quality(d.where("false"), none, ["doc_id"]).count() == 0
    bad = quality.fit_quality(d, labels(spark).where("quality = 0"))
    assert {r.predicted for r in quality.score_quality(d, bad, ["doc_id"]).collect()} == {0}


def test_new_columns_win_over_clashing_ones(spark):
    d = docs(spark, 12).selectExpr("*", "'old' as score", "'old' as lang_pred", "'old' as n_tokens")
    model = quality.fit_quality(d, labels(spark, 12))
    assert dict(quality.score_quality(d, model, d.columns).dtypes)["score"] == "double"
    assert dict(langid.identify(d, langid.fit_profiles(d), d.columns).dtypes)["score"] == "double"


LANGS = {"en": "the house and the tree are there with this and that", "de": "der hund und die katze sind nicht schön auf dem dach", "es": "el niño y la casa están en la montaña por qué"}


def test_language_by_rank_order(spark):
    rows = [(i, " ".join(random.Random(i).sample(t.split(), 8)), k, "s") for i, (k, t) in enumerate(sorted(LANGS.items()) * 30)]
    d = spark.createDataFrame([*rows, (900, None, "en", "s"), (901, "", None, "s"), (902, "123 !?", "de", "s"), (None, LANGS["de"], None, None), (903, (LANGS["es"] + " ") * 2000, None, None)], DOCS)
    model = langid.fit_profiles(d)
    got = langid.identify(d, model, ["doc_id", "lang"]).collect()
    assert len(got) == d.count()
    assert sum(r.lang_pred == r.lang for r in got if r.doc_id is not None and r.doc_id < 90) >= 88
    by_id = {r.doc_id: r for r in got}
    assert {by_id[i].lang_pred for i in (900, 901, 902)} == {"und"} and by_id[None].lang_pred == "de" and by_id[903].lang_pred == "es"
    assert all(0 <= r.score <= 1 for r in got)
    empty = langid.fit_profiles(d.where("false"))
    assert {r.lang_pred for r in langid.identify(d, empty, ["doc_id"]).collect()} == {"und"}


@pytest.mark.parametrize("most", [5, 2000])
def test_an_id_on_many_rows_is_one_document(spark, most):
    """Each language is learned, whichever id is on thousands of rows; of its texts one counts."""
    for hot in (0, 1, 7, 10):
        rows = [(hot, LANGS["de"], "de", None)] * 3000 + [(hot, LANGS["de"] + " zzz", "de", None)] * 3000 + [(i, LANGS["en"], "en", None) for i in range(100, 160)]
        model = langid.fit_profiles(spark.createDataFrame(rows, DOCS).repartition(8), most=most)
        assert model.languages == (["en"] if zlib.crc32(str(hot).encode()) % 3 == 1 else ["de", "en"])
        assert all(len(c) > 20 for c in model.codes)


def test_equally_near_languages_give_the_first(spark):
    d = spark.createDataFrame([(i, LANGS["en"], k, None) for i, k in enumerate(["xx", "aa"] * 20)], DOCS)
    assert {r.lang_pred for r in langid.identify(d, langid.fit_profiles(d), ["doc_id"]).collect()} == {"aa"}


@pytest.fixture(scope="module")
def coder():
    with open(public_tokenizers.path(bpe.VOCABULARY), "rb") as f:
        return bpe.coder(f.read(), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference(coder):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})


def test_bpe_equals_the_library(coder, reference):
    rng = random.Random(3)
    alphabet = ["a", "b", "th", "e", "é", "漢", "😀", "!", "aaaa", " ", "\n", "1", "x" * 40, "<|endoftext|>", "'s", " ", "\x00"]
    for _ in range(150):
        text = "".join(rng.choices(alphabet, k=rng.choice([0, 1, 7, 60, 900])))
        ids = coder.encode(text)
        assert ids == reference.encode_ordinary(text)
        assert coder.decode(ids) == text.encode()


@pytest.mark.parametrize("n", [bpe.MATRIX_BYTES - 1, bpe.MATRIX_BYTES, bpe.MATRIX_BYTES + 1, 5000])
def test_long_pieces(coder, reference, n):
    rng = random.Random(n)
    text = "".join(rng.choices("abcdeéthx", k=n))
    assert coder.encode(text) == reference.encode_ordinary(text)
    assert coder.encode("a" * n) == reference.encode_ordinary("a" * n)


def test_bpe_rows(spark, reference):
    d = docs(spark, 12)
    out = bpe.encode_documents(d, public_tokenizers.path(bpe.VOCABULARY), public_tokenizers.PATTERN, ["doc_id", "text"], with_ids=True).collect()
    assert len(out) == d.count()
    for r in out:
        want = reference.encode_ordinary(r.text or "")
        assert r.ids == want and r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()

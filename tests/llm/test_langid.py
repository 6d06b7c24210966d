"""Languages: held-out accuracy, codes, n-grams, edge cases."""

from itertools import combinations

import numpy as np
import pytest

from keyedload.llm import langid
from keyedload.llm.common import crc_remainder

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("n", [2, 3, 4, 6, 7, 20])
def test_codewords_are_apart(n):
    code = langid.codewords(n)
    assert set(np.unique(code)) <= {-1.0, 1.0}
    assert all((code[i] != code[j]).sum() >= max(1, code.shape[1] // 5) for i, j in combinations(range(n), 2))
    assert (np.abs(code.sum(axis=0)) < n).all()


def test_grams_do_not_depend_on_the_pieces(monkeypatch):
    data = langid.letters("Some words of a text, éà and 12 more.")
    whole = np.sort(np.concatenate(list(langid.grams(data))))
    monkeypatch.setattr(langid, "GRAMS_AT_ONCE", 5)
    assert (np.sort(np.concatenate(list(langid.grams(data)))) == whole).all()


@pytest.mark.parametrize("text", ["½", "²³", "① ②", "Ⅷ", "１２３", "__", "...", "\u0301", "\U0001f600", ""])
def test_what_is_no_letter_has_no_language(text):
    assert langid.letters(text) == b""


@pytest.mark.parametrize("text", ["a½", "é", "漢", "ß²", "ªb", "हिन्दी"])
def test_what_is_a_letter(text):
    assert langid.letters(text) != b""


def plain_decode(model, text):
    """Each bit by adding up its classifier, each language by adding up the bits' losses."""
    data = langid.letters(text)
    grams = []
    for n in (2, 3, 4):
        for i in range(len(data) - n + 1):
            key = 0
            for byte in data[i : i + n]:
                key = (key * 257 + byte) % 2**32
            grams.append((((key + n) * 2654435761) % 2**32) >> 16)
    bits = len(model.weights)
    margins = [sum(float(model.odds[g, b]) for g in grams) * min(len(grams), 400) / len(grams) / 10 for b in range(bits)]
    losses = [
        sum(float(w) * float(np.log1p(np.exp(-m * c))) for w, m, c in zip(model.weights, margins, word)) for word in model.code.tolist()
    ]
    best = min(range(len(losses)), key=lambda i: (losses[i], model.languages[i]))
    return model.languages[best], float(np.exp(-losses[best]) / sum(np.exp(-x) for x in losses))


@pytest.mark.parametrize("names", [["de", "en"], ["de", "en", "es", "fr"], list("abcdefghi")])
def test_decoding_is_that_of_plain_sums(spark, names):
    rng = np.random.default_rng(len(names))
    code = langid.codewords(len(names))
    odds = rng.normal(0, 0.3, (langid.BUCKETS, code.shape[1])).astype(np.float32)
    model = langid.Model(names, code, odds, rng.uniform(0.2, 2, code.shape[1]))
    texts = ["a", "Some words, and 12 numbers", "é à ü", "x " * 700, "漢字 kana"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    for r in langid.languages(docs, model).collect():
        lang, score = plain_decode(model, texts[r.doc_id])
        assert r.lang_pred == lang and r.score == pytest.approx(score, abs=1e-6)


def test_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    held = crc_remainder("doc_id", 4) == 2
    model = langid.train(docs.where(~held))
    assert model.languages == ["de", "en", "es", "fr"]
    seen = langid.languages(docs, model).join(docs.where(held).select("doc_id", "lang"), "doc_id").toPandas()
    assert (seen["lang"] == seen["lang_pred"]).mean() > 0.98
    assert seen["score"].between(0, 1).all()


def test_a_mixed_text_is_ambiguous(spark):
    rows = [("aa ab ba bb " * 50, "x"), ("cc cd dc dd " * 50, "y"), ("ee ef fe ff " * 50, "z"), ("gg", None), (None, "x"), ("123", "w")]
    model = langid.train(spark.createDataFrame(rows, "text string, lang string"))
    assert model.languages == ["x", "y", "z"]
    asked = [(1, "ab ba"), (2, "aa ab cc cd"), (3, None), (4, "12 !"), (None, "ef fe"), (1, "ab ba"), (6, "dd " * 200_000)]
    docs = spark.createDataFrame([(*a, "c") for a in asked], "doc_id bigint, text string, score string")
    got = sorted((str(r.doc_id), r.lang_pred, r.ambiguous) for r in langid.languages(docs, model).collect())
    assert [g[:2] for g in got if g[0] != "2"] == [("1", "x"), ("1", "x"), ("3", "und"), ("4", "und"), ("6", "y"), ("None", "z")]
    assert [g[2] for g in got if g[0] == "2"] == [True]


def test_nothing_to_learn(spark):
    model = langid.train(spark.createDataFrame([], "text string, lang string"))
    docs = spark.createDataFrame([(1, "some text")], "doc_id int, text string")
    assert [(r.lang_pred, r.score) for r in langid.languages(docs, model).collect()] == [("und", 0.0)]

"""Language models: probabilities that sum to one, held-out accuracy, odd texts."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import langid
from tidemark.llm.queries import op1_langid

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(SF + "/documents.parquet")
    return langid.train(docs.where(~langid.held_out()))


def small_fit():
    counts = {}
    for lang, text in {"aa": "abracadabra abba", "bb": "banana bandana"}.items():
        chars, ends, _ = langid.codes([text])
        rows = chars[ends[:, None] - np.arange(langid.ORDER - 1, -1, -1)].astype("<u4")
        grams, n = np.unique(rows, axis=0, return_counts=True)
        counts[lang] = grams, n
    return langid.fit(counts)


def test_probabilities_sum_to_one():
    """Over the alphabet and one unseen character, after any context, seen or not."""
    model = small_fit()
    alphabet = sorted(set("abracadabra abba banana bandana")) + ["z"]
    for context in ["abra", "bana", "zzzz", "a"]:
        logs = []
        for c in alphabet:
            chars, ends, _ = langid.codes([context + (c if c != " " else " x")])
            logs.append(model.char_logs(chars, ends)[len(context)])
        assert np.exp(logs).sum(axis=0) == pytest.approx(np.ones(2), abs=1e-4)


def test_interpolation_by_hand():
    """One order against the formula: first share plus back-off times the shorter gram's."""
    model = small_fit()
    chars, ends, _ = langid.codes(["abra"])
    got = np.exp(model.char_logs(chars, ends)[-1, 0])
    levels = langid._estimate(*[x for x in _counts("abracadabra abba")])
    p = np.exp(model.base)
    for n in range(langid.ORDER):
        grams, share, names, back = levels[n]
        gram = np.array([[0x20] * 5 + [ord(c) for c in "abra"]])[:, -(n + 1) :]
        h, c = langid._level(gram)
        at, hit = langid._find(names, c)
        p = p * (back[at[0]] if hit[0] else 1)
        mine = np.flatnonzero(langid._level(grams)[0] == h[0])
        p += share[mine[0]] if len(mine) else 0
    assert got == pytest.approx(p, rel=1e-4)


def _counts(text):
    chars, ends, _ = langid.codes([text])
    rows = chars[ends[:, None] - np.arange(langid.ORDER - 1, -1, -1)].astype("<u4")
    return np.unique(rows, axis=0, return_counts=True)


def test_texts_do_not_mix(model):
    texts = ["", "the and of", "x", "la de que", "!!", "the and of"]
    together = model.entropies(texts)[1]
    for k, text in enumerate(texts):
        assert np.allclose(model.entropies([text])[1][0], together[k], atol=1e-5)


def test_odd_rows(make_docs, model):
    texts = [None, "", "123 !!", "the", "the " * 30_000, "日本語テキスト" * 40, "xqzjkvw" * 60, "\0", "the"]
    docs = make_docs(texts).withColumn("score", F.lit("x")).withColumn("accepted", F.lit("x"))
    got = {r.doc_id: r for r in langid.identify(docs, model).collect()}
    assert len(got) == len(texts) and all(0 <= r.score <= 1 for r in got.values())
    for k in (0, 1, 2, 7):
        assert got[k].lang_pred == langid.NONE and not got[k].accepted
    assert got[3].lang_pred == got[8].lang_pred != langid.NONE
    assert not got[5].accepted and not got[6].accepted
    assert langid.identify(docs.limit(0), model).count() == 0


def test_without_labels(make_docs):
    docs = make_docs(["some text"], lang=None)
    model = langid.train(docs)
    assert [r.lang_pred for r in langid.identify(docs, model).collect()] == [langid.NONE]


def test_held_out_accuracy(spark):
    got = op1_langid(spark, SF).join(spark.read.parquet(SF + "/documents.parquet"), "doc_id").where("held_out").collect()
    assert len(got) > 30
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.97
    assert np.mean([r.accepted for r in got]) > 0.97


def test_few_distinct_texts_are_learned(spark):
    """A language of one text, and one whose text has very many copies: both learned, few rows drawn."""
    rows = [("the quick brown fox jumps over the lazy dog " * 20, "en")] * 3000
    rows += [("le renard brun saute par dessus le chien paresseux " * 20, "fr")]
    rows += [(f"der schnelle braune fuchs {k} springt ueber den faulen hund " * 20, "de") for k in range(40)]
    docs = spark.createDataFrame([(i, t, x) for i, (t, x) in enumerate(rows)], "doc_id long, text string, lang string")
    for chars in (100, 2000, langid.SAMPLE_CHARS):
        drawn = langid.sample(docs, chars)
        assert drawn.count() <= 42
        assert drawn.where("not kept_out").select("lang").distinct().count() == 3
        model = langid.train(docs, chars)
        assert model.langs == ["de", "en", "fr"]
    got = {r.doc_id: r.lang_pred for r in langid.identify(docs.where("doc_id > 2999"), model).collect()}
    assert got[3000] == "fr" and got[3001] == "de"


def test_training_goes_through_texts_in_slices(make_docs, monkeypatch, tmp_path):
    """However many texts a task gets, it holds a slice of them at a time, and the counts are the same."""
    texts = [f"{a} {b} {c}" for a in ("alpha", "beta", "gamma") for b in ("delta", "eps") for c in range(40)]
    docs = make_docs(texts).coalesce(1)
    whole = langid.train(docs)
    note, real = str(tmp_path / "sizes"), langid.codes

    def measured(some):
        with open(note, "a") as file:
            file.write(f"{sum(map(len, some))} ")
        return real(some)

    monkeypatch.setattr(langid, "BATCH_BYTES", 200)
    monkeypatch.setattr(langid, "codes", measured)
    sliced = langid.train(docs)
    assert max(int(x) for x in open(note).read().split()) <= 200
    for a, b in zip(whole.grams + whole.logp, sliced.grams + sliced.logp):
        assert np.array_equal(a, b)

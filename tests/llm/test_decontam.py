"""Decontamination against scoring every passage with every item, and its verification."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontam
from tidemark.llm.decontam import BREAK
from tidemark.llm.words import words


def made_words(rng, n):
    return [f"w{int(rng.paretovariate(0.6)) % 5000}" for _ in range(n)]


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(8)
    items = [(k, *decontam.split_item(" ".join(made_words(rng, rng.randint(12, 200))) + ". Answer is " + " ".join(made_words(rng, rng.randint(1, 9))) + "."))
             for k in range(60)]
    docs = []
    for k in range(150):
        said = made_words(rng, rng.choice([0, 3, 60, 130, 700]))
        if k % 3 == 0:
            _, q, a = rng.choice(items)
            at = rng.randint(0, len(said))
            said = said[:at] + (q + "\n" + a).split() + said[at:]
        docs.append(" ".join(said))
    return items, docs


def plain_words(text):
    return re.findall("[a-z0-9\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_scores(items, text):
    """The best score of each item over a text's passages, straight from the formula."""
    lists = [plain_words(f"{q} {a}") for _, q, a in items]
    mean = np.mean([len(x) for x in lists])
    df = {}
    for x in lists:
        for w in set(x):
            df[w] = df.get(w, 0) + 1

    def score(query, item):
        total = 0.0
        for w in set(query) & set(item):
            tf = item.count(w)
            idf = np.log1p((len(lists) - df[w] + 0.5) / (df[w] + 0.5))
            total += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(item) / mean))
        return total

    said, s = plain_words(text), decontam.STRIDE
    starts = range(0, max(1, len(said) - s), s)
    out = {}
    for k, item in enumerate(lists):
        least = min(score(item[a : a + s], item) for a in range(max(1, len(item) - s + 1)))
        out[k] = max(score(said[a : a + 2 * s], item) for a in starts) / least
    return out


def test_retrieval_is_exact(corpus):
    items, docs = corpus
    index = decontam.build(items)
    assert not index.essential.all()
    text, item, score = decontam.retrieve(index, words(pa.array(docs, pa.string()), True, BREAK))
    got = {(t, i): s for t, i, s in zip(text.tolist(), item.tolist(), score.tolist())}
    for t, doc in enumerate(docs):
        for i, s in plain_scores(items, doc).items():
            if abs(s - decontam.THRESHOLD) > 1e-9:
                assert ((t, i) in got) == (s > decontam.THRESHOLD)
                assert got.get((t, i), s) == pytest.approx(s)


def overlap(part, doc):
    part, doc = plain_words(part), plain_words(doc)
    k = min(5, len(part))
    runs = lambda ws: {tuple(ws[i : i + k]) for i in range(len(ws) - k + 1)}
    return len(runs(part) & runs(doc)) / len(runs(part)) if k else 0.0


@pytest.mark.parametrize("shard_words", [decontam.SHARD_WORDS, 300])
def test_every_copied_item_is_found(spark, make_docs, corpus, shard_words):
    items, docs = corpus
    frame = spark.createDataFrame(items, "item_id long, question string, answer string")
    texts = make_docs(docs).withColumn("item_id", F.lit("x")).withColumn("score", F.lit("x"))
    got = {(r.doc_id, r.item_id): (r.question_overlap, r.answer_overlap) for r in decontam.contaminated(texts, frame, shard_words).collect()}
    want = {(d, i): (overlap(q, doc), overlap(a, doc)) for d, doc in enumerate(docs) for i, q, a in items if overlap(q, doc) >= decontam.OVERLAP}
    assert len(want) >= 50
    assert set(got) == set(want)
    for pair, shares in want.items():
        assert got[pair] == pytest.approx(shares)


def question_copies():
    """Items whose answer holds most of the weight, and texts with their question only, whole or in pieces."""
    rng = random.Random(11)
    items, docs = [], []
    for k in range(40):
        size = rng.choice([3, 5, 9, 12, 30, 150])
        asked = [f"q{rng.randint(0, 300)}" for _ in range(size)]
        items.append((k, " ".join(asked), " ".join(f"z{rng.randint(0, 90_000)}" for _ in range(rng.choice([0, 5, 25, 80])))))
        said = made_words(rng, rng.choice([0, 40, 400]))
        docs.append(" ".join(said + asked + said))
        docs.append(" ".join(said + asked[: -max(1, size // 10)] + said))
        pieces = [asked[a : a + 24] for a in range(0, max(1, size - 4), 20)]
        docs.append(" ".join(w for piece in pieces for w in piece + made_words(rng, 300)))
    return items, docs


def test_question_without_answer_is_found(spark, make_docs):
    items, docs = question_copies()
    frame = spark.createDataFrame(items, "item_id long, question string, answer string")
    got = {(r.doc_id, r.item_id): r for r in decontam.contaminated(make_docs(docs), frame).collect()}
    want = {(d, i): (overlap(q, doc), overlap(a, doc)) for d, doc in enumerate(docs) for i, q, a in items if overlap(q, doc) >= decontam.OVERLAP}
    assert set(got) == set(want)
    low = 0
    for (d, i), shares in want.items():
        row = got[d, i]
        assert (row.question_overlap, row.answer_overlap) == pytest.approx(shares)
        if d < 9:
            assert row.score == pytest.approx(plain_scores(items, docs[d])[i])
        low += row.score < decontam.THRESHOLD
    assert low >= 30
    kept = {r.doc_id for r in decontam.clean(make_docs(docs), frame).collect()}
    assert kept == set(range(len(docs))) - {d for d, _ in want}


def test_scores_do_not_hang_on_the_shards(spark, make_docs):
    """Many small indexes give the rows and scores of one."""
    items, docs = question_copies()
    frame = spark.createDataFrame(items, "item_id long, question string, answer string")
    found = [
        {(r.doc_id, r.item_id): (round(r.score, 9), r.question_overlap, r.full) for r in decontam.contaminated(make_docs(docs), frame, n).collect()}
        for n in (decontam.SHARD_WORDS, 60)
    ]
    assert found[0] == found[1] and len(found[0]) > 30


def test_odd_rows(spark, make_docs):
    item = "One two three four five six seven eight nine ten eleven twelve. Thirteen."
    items = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "..."), (1, item), (None, item)], "item_id long, text string")
    docs = make_docs([None, "", item.upper(), "x " * 60_000 + item + " y" * 60_000, "one two three four five", (7, item), (7, item), (None, item)])
    got = sorted((-9 if r.doc_id is None else r.doc_id, r.item_id, r.full) for r in decontam.contaminated(docs, items).collect())
    assert got == sorted((d, i, True) for d in (-9, 2, 3, 7, 7) for i in (-1, 1, 1))
    assert sorted(r.doc_id for r in decontam.clean(docs, items).collect()) == [0, 1, 4]
    assert decontam.contaminated(docs, items.limit(0)).count() == 0
    assert decontam.contaminated(docs.limit(0), items).count() == 0


def test_split_item():
    assert decontam.split_item(None) == ("", "")
    assert decontam.split_item("What is it? A dog.") == ("What is it? A dog.", "")
    q, a = decontam.split_item("a b c d e f g h i j k. The answer.")
    assert (q.split()[-1], a) == ("k.", "The answer")

"""MinHash near dedup against all pairs, and its estimates against exact counts."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_jaccard import ODD, least_reachable, variants
from tidemark.llm import minhash


def shingle_set(text, size):
    import re

    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def plain(rows, size=3, similar=(85, 100)):
    sets = {i: shingle_set(t, size) for i, t in rows}
    ids = sorted(sets)
    num, den = similar
    links = [
        (a, b) for k, a in enumerate(ids) for b in ids[k + 1 :]
        if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])
    ]
    up = least_reachable(ids, links)
    return {(i, len(sets[i]), up[i], i == up[i]) for i in ids}


def family(seed, members, length, edits):
    """Members of one template, each edited in many places: alike, but mostly not linked."""
    rng = random.Random(seed)
    base = [f"t{k}" for k in range(length)]
    texts = []
    for m in range(members):
        words = list(base)
        for at in rng.sample(range(length), edits):
            words[at] = f"m{m}x{at}"
        texts.append(" ".join(words))
    return texts


@pytest.mark.parametrize("seed,families,members,length,edits", [(1, 40, 6, 60, 3), (2, 3, 60, 300, 9), (3, 30, 8, 12, 1)])
def test_against_all_pairs(make_docs, seed, families, members, length, edits):
    rows = list(enumerate(variants(seed, families, members, length, edits) + ODD))
    docs = make_docs(rows).withColumn("node", F.lit("x")).withColumn("kept", F.lit("x")).withColumn("a", F.lit("x"))
    got = minhash.similar_documents(docs).drop("links").collect()
    assert {tuple(r) for r in got} == plain(rows)


@pytest.mark.parametrize("edits", [4, 6, 9])
def test_alike_but_not_linked(make_docs, edits):
    rows = list(enumerate(family(8, 150, 200, edits)))
    got = minhash.similar_documents(make_docs(rows)).drop("links").collect()
    assert {tuple(r) for r in got} == plain(rows)


def test_other_limits(make_docs):
    rows = list(enumerate(variants(9, 20, 6, 60, 4)))
    got = minhash.similar_documents(make_docs(rows), 5, (80, 100)).drop("links").collect()
    assert {tuple(r) for r in got} == plain(rows, 5, (80, 100))


def test_odd_tables(make_docs):
    assert minhash.similar_documents(make_docs([])).count() == 0
    got = minhash.similar_documents(make_docs([None, ""])).collect()
    assert sorted((r.component_id, r.kept) for r in got) == [(0, True), (1, True)]
    rows = [(5, "a b c d e"), (5, "a b c d e"), (7, "a b c d e"), (None, "a b c d e"), (5, "z y x w v"), (9, "z y x w v"), (None, None)]
    got = sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in minhash.similar_documents(make_docs(rows)).collect())
    assert got == [(0, 0, True), (0, 5, False), (5, 5, True), (5, 5, True), (5, 5, True), (7, 5, False), (9, 5, False)]


def test_agreement_is_counted(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 4, (200, 128), dtype=np.uint8) * np.uint8(85)
    y = rng.integers(0, 4, (200, 128), dtype=np.uint8) * np.uint8(85)
    rows = [(a.view(np.int64).tolist(), b.view(np.int64).tolist(), int((a == b).sum())) for a, b in zip(x, y)]
    df = spark.createDataFrame(rows, "x array<long>, y array<long>, want int")
    assert df.where(minhash.agreement(F.col("x"), F.col("y")) != F.col("want")).count() == 0


def test_minima_estimate_similarity():
    rng = np.random.default_rng(2)
    for share in (0.3, 0.6, 0.85):
        common = rng.integers(0, 1 << 63, int(1000 * share), dtype=np.uint64)
        sides = [np.concatenate([common, rng.integers(0, 1 << 63, (1000 - len(common)) // 2, dtype=np.uint64)]) for _ in "ab"]
        n = np.array([len(s) for s in sides])
        least = minhash.minima(np.concatenate(sides), np.cumsum(n) - n, 2048)
        assert abs((least[0] == least[1]).mean() - share) < 0.05


def test_bands_suffice():
    for similar in ((85, 100), (80, 100), (1, 1)):
        for rows in (minhash.ROWS, minhash.FINE):
            t = similar[0] / similar[1]
            assert (1 - t**rows) ** minhash.n_bands(rows, similar) <= minhash.MISS * 1.01
    assert 75 < minhash.least_agreement() < 90

"""The n-gram join against all pairs, its bound's soundness, components against union-find."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import jaccard
from tidemark.llm.components import components


def shingle_set(text, size=4):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def least_reachable(nodes, links):
    up = {n: n for n in nodes}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def plain(rows, size=4, similar=(85, 100)):
    num, den = similar
    sets = {i: shingle_set(t, size) for i, t in rows}
    ids = sorted(sets)
    links = [
        (a, b) for k, a in enumerate(ids) for b in ids[k + 1 :]
        if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])
    ]
    up = least_reachable(ids, links)
    return {(i, len(sets[i]), up[i]) for i in ids}


def variants(seed, families, members, length, edits):
    """Families of near copies whose similarity straddles the limit."""
    rng = random.Random(seed)
    texts = []
    for _ in range(families):
        base = [rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randint(0, 400)) for _ in range(rng.randint(3, length))]
        for _ in range(members):
            words = list(base)
            for _ in range(rng.randint(0, edits)):
                words[rng.randrange(len(words))] = f"x{rng.randint(0, 9999)}"
            texts.append(rng.choice([" ", "\n", " \t "]).join(words))
    rng.shuffle(texts)
    return texts


ODD = [None, "", " \n", "one", "ONE", "one two three", "one  two three", "one two three four", "Ä b c d", "ä b c d",
       "a a a a a a a", "a a a a", "w " * 40_000, "w " * 39_000, None]


@pytest.mark.parametrize("seed,families,members,length,edits", [(1, 40, 6, 60, 3), (2, 3, 60, 300, 9), (3, 30, 8, 12, 1)])
def test_against_all_pairs(make_docs, seed, families, members, length, edits):
    rows = list(enumerate(variants(seed, families, members, length, edits) + ODD))
    docs = make_docs(rows).withColumn("node", F.lit("x")).withColumn("links", F.lit("x")).withColumn("a", F.lit("x"))
    got = jaccard.similar_documents(docs).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == plain(rows)


@pytest.mark.parametrize("edits", [5, 8])
def test_alike_but_not_linked(make_docs, edits):
    """Members of one template, some linked in chains, most not."""
    rng = random.Random(11)
    rows = []
    for m in range(160):
        words = [f"t{k}" for k in range(220)]
        for at in rng.sample(range(220), edits):
            words[at] = f"m{m}x{at}"
        rows.append((m, " ".join(words)))
    got = jaccard.similar_documents(make_docs(rows)).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == plain(rows)


def test_shared_parts_without_links(spark, make_docs, monkeypatch):
    """2000 documents that share a long passage: few pairs are left to verify."""
    rng = random.Random(12)
    passage = [f"p{k}" for k in range(120)]
    rows = [(m, " ".join(passage + [f"w{rng.randrange(10**9)}" for _ in range(60)])) for m in range(2000)]
    pairs, verify = [], jaccard.verified
    monkeypatch.setattr(jaccard, "verified", lambda found, *how: pairs.append(found.count()) or verify(found, *how))
    got = jaccard.similar_documents(make_docs(rows))
    assert got.where("doc_id != component_id").count() == 0
    assert sum(pairs[2:]) < 2000, pairs


def test_few_pairs_of_long_documents_leave_the_last_join(make_docs, monkeypatch):
    """60 documents of 997 tokens that share two thirds of them, all of which meet under some key."""
    rng = random.Random(13)
    passage = [f"p{k}" for k in range(800)]
    rows = [(m, " ".join(passage + [f"w{rng.randrange(10**9)}" for _ in range(200)])) for m in range(60)]
    left, cross = [], jaccard._cross_links

    def counted(*args):
        out = cross(*args)
        left.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "_cross_links", counted)
    got = jaccard.similar_documents(make_docs(rows))
    assert got.where("doc_id != component_id").count() == 0
    assert left[0] < 100, left


def test_parted_bounds_the_difference(spark):
    """As ``apart``, within Spark, for sets of one band and of neighbouring ones."""
    rng = np.random.default_rng(8)
    rows = []
    for n in [1, 3, 40, 63, 64, 130, 500] * 6:
        tokens = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        for other in (tokens, tokens[n // 20 :], np.concatenate([tokens, rng.integers(0, 2**63, n // 10, dtype=np.uint64)])):
            x, y = jaccard.parity_bits(tokens), jaccard.parity_bits(other)
            both = [np.frombuffer(b, "<i8").tolist() for b in (x, y)]
            rows.append((*both, jaccard.apart(x, y)))
    table = spark.createDataFrame(rows, "x array<long>, y array<long>, want int")
    assert len({len(r[0]) == len(r[1]) for r in rows}) == 2
    got = table.select(jaccard._parted(F.col("x"), F.col("y")).alias("got"), "want").collect()
    assert all(r.got == r.want for r in got)


def test_bits_bound_the_difference():
    """The bits of two sets, of one band or of two, never differ in more places than the sets."""
    rng = np.random.default_rng(3)
    for _ in range(300):
        n = int(rng.integers(1, 500))
        tokens = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        a = tokens[rng.random(len(tokens)) < 0.9]
        b = tokens[rng.random(len(tokens)) < rng.choice([0.4, 0.9])]
        if len(a) and len(b):
            apart = jaccard.apart(jaccard.parity_bits(a), jaccard.parity_bits(b))
            assert apart <= len(np.setxor1d(a, b)) and (apart - len(np.setxor1d(a, b))) % 2 == 0
            assert jaccard.apart(jaccard.parity_bits(a), jaccard.parity_bits(a)) == 0


def test_other_limits(make_docs):
    rows = list(enumerate(variants(9, 20, 6, 60, 4)))
    got = jaccard.similar_documents(make_docs(rows), 5, (80, 100)).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == plain(rows, 5, (80, 100))


@pytest.mark.parametrize("similar", [(85, 100), (80, 100)])
def test_linked_sets_share_fine_sketches(similar):
    """At the limit, pairs have as many fine sketches in common as their number asks for."""
    rng = np.random.default_rng(7)
    num, den = similar
    for _ in range(60):
        n = int(rng.integers(8, 600))
        union = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        most = n - -(-num * n // den)
        gone = rng.permutation(n)[:most]
        a, b = np.delete(union, gone[: most // 2]), np.delete(union, gone[most // 2 :])
        keys = [set(jaccard.fine_keys(s, np.array([len(s)]), similar)[0].tolist()) for s in (a, b)]
        assert len(keys[0] & keys[1]) >= 4


def test_keep_one_with_clashing_names(make_docs):
    rows = [(1, "a b c d e"), (1, "a b c d e"), (2, "a b c d e"), (3, "x y z"), (None, None), (4, "")]
    docs = make_docs(rows)
    for name in ("_id", "_a", "a", "n", "_n", "_digest", "component_id"):
        docs = docs.withColumn(name, F.lit(name))
    got = jaccard.keep_one(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id or 0, r["_id"], r.a) for r in got.collect()) == [(i, "_id", "a") for i in (0, 1, 3, 4)]


def test_odd_tables(make_docs):
    assert jaccard.similar_documents(make_docs([])).count() == 0
    got = jaccard.similar_documents(make_docs([None, ""])).collect()
    assert sorted(r.component_id for r in got) == [0, 1]
    rows = [(5, "a b c d e"), (5, "a b c d e"), (7, "a b c d e"), (None, "a b c d e"), (5, "z y x w v"), (9, "z y x w v")]
    got = sorted((r.doc_id or 0, r.component_id) for r in jaccard.similar_documents(make_docs(rows)).collect())
    assert got == [(0, 5), (5, 5), (5, 5), (5, 5), (7, 5), (9, 5)]


def test_linked_sets_share_a_part():
    """Random pairs at the limit, of all sizes and across band ends, share a key."""
    rng = np.random.default_rng(4)
    for _ in range(1500):
        n = int(rng.integers(1, 400))
        union = rng.integers(0, 2**63, n, dtype=np.uint64)
        most = n - -(-85 * n // 100)
        gone = rng.permutation(n)[: int(rng.integers(0, most + 1)) if rng.random() < 0.3 else most]
        split = int(rng.integers(0, len(gone) + 1))
        a, b = np.delete(union, gone[:split]), np.delete(union, gone[split:])
        assert 100 * len(np.intersect1d(a, b)) >= 85 * len(np.union1d(a, b))
        keys = []
        for s in (np.unique(a), np.unique(b)):
            k, _ = jaccard.part_keys(s, np.zeros(len(s), np.int64), np.array([len(s)]))
            keys.append(set(k.tolist()))
        assert keys[0] & keys[1]


def test_keys_stay_in_proportion():
    rng = np.random.default_rng(5)
    for n in (16, 31, 200, 255, 3000, 20_000):
        s = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        k, _ = jaccard.part_keys(s, np.zeros(len(s), np.int64), np.array([len(s)]))
        assert len(k) < 0.45 * n + 2


def test_components(spark):
    rng = random.Random(6)
    nodes = list(range(400))
    links = [(i, i + 1) for i in range(100, 200)] + [(300, i) for i in range(301, 399)]
    links += [(rng.randrange(100), rng.randrange(100)) for _ in range(60)] + [(7, 7), (201, 200), (200, 201)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = least_reachable(nodes, links)
    assert got and all(want[n] == label for n, label in got.items())
    assert {n for pair in links for n in pair if pair[0] != pair[1]} == set(got)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0

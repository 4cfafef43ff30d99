"""Collocation mining against plain counting."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import collocations


def plain(rows, longest=3, least=10, covered=50, top=2000):
    total, f = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    out = {}
    candidates = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    for (lang, phrase), a in candidates.items():
        longer = [
            b for (x, other), b in candidates.items()
            if x == lang and any(other[i : i + len(phrase)] == phrase for i in range(len(other) - len(phrase) + 1)) and len(other) > len(phrase)
        ]
        if any(100 * b >= covered * a for b in longer):
            continue
        cuts = []
        for cut in range(1, len(phrase)):
            left, right = f[lang, phrase[:cut]], f[lang, phrase[cut:]]
            cuts.append((1_000_000 * a * a // (left * right), cut, left, right))
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(phrase).encode(), left, right))
    return {
        (lang, k, p.decode(), -a, left, right, total[lang], -s)
        for lang, found in out.items() for k, (s, a, p, left, right) in enumerate(sorted(found)[:top], start=1)
    }


def texts(seed, n):
    rng = random.Random(seed)
    fixed = ["new york city", "of the", "New York", "ad hoc basis", "a a a a", "the end of the road"]
    bits = fixed + ["x", "the", "of", "city", "ÄB", "äb", "é\x1cf", "a", "b-c", "new", "日本", "end"]
    ends = [" ", " ", "  ", "\t", ". ", ", ", "\n", ";", "!", "\x0b", "\r\n", " : "]
    rows = []
    for _ in range(n):
        text = "".join(rng.choice(bits) + rng.choice(ends) for _ in range(rng.randint(0, 40)))
        rows.append((rng.choice(["en", "fr", None, "und", ""]), text))
    return rows


def run(spark, rows, **how):
    df = spark.createDataFrame([(i, t, x) for i, (x, t) in enumerate(rows)], "doc_id long, text string, lang string")
    df = df.withColumn("word", F.lit("clash")).withColumn("id", F.lit(1)).withColumn("chunk", F.lit(1)).withColumn("seq", F.lit(1))
    return {tuple(r) for r in collocations.collocations(df, **how).collect()}


ODD = [("en", None), (None, None), ("en", ""), (None, "..,; \n"), ("fr", " \t "), ("en", "new york " * 3000), ("en", "solo")]


@pytest.mark.parametrize("chunk", [200, collocations.CHUNK_BYTES])
def test_against_plain(spark, chunk):
    rows = texts(1, 400) + ODD
    rows += rows[:30]
    got = run(spark, rows, chunk_bytes=chunk)
    assert got == plain(rows)
    assert len({r[0] for r in got}) == 4


@pytest.mark.parametrize("longest,least,covered,top", [(2, 3, 50, 5), (5, 4, 80, 60), (3, 1, 101, 40)])
def test_other_settings(spark, longest, least, covered, top):
    rows = texts(2, 60) + ODD[:-2]
    assert run(spark, rows, longest=longest, least=least, covered=covered, top=top) == plain(rows, longest, least, covered, top)


def test_nothing(spark):
    assert run(spark, []) == set()
    assert run(spark, [("en", None), ("en", "one two"), (None, "...")]) == set()


def test_scores_beyond_64_bits(spark):
    a, left, right = 9_000_000_000_001, 9_500_000_000_000, 12_000_000_000_007
    df = spark.createDataFrame([(a, left, right)], "a long, l long, r long")
    got = df.select(collocations._score(F.col("a"), F.col("l"), F.col("r"))).first()[0]
    assert got == 1_000_000 * a * a // (left * right)


def test_relation_is_read_by_its_buckets(spark, make_docs):
    """The semi-join shuffles the groups, not the occurrences."""
    found = collocations.Relation(collocations.occurrences(make_docs(["a b c " * 20])), "occurrences")
    counted = found.rows().where("seq is null").select("chunk", "place", "lang", "word", "f")
    groups = collocations.frequent(counted, ["lang", "word"], 2)
    plan = collocations.semi_joined(found.rows().where("seq is not null"), groups.select("chunk", "place", "id"), collocations.renamed)
    text = plan._jdf.queryExecution().toString().split("Physical Plan")[1]
    assert text.count("Exchange") == 1
    found.drop()

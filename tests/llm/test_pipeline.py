"""The pipeline stage by stage against plain versions of each."""

from __future__ import annotations

import pytest

import corpus_pipeline
from tests.llm.test_decontam import overlap
from tests.llm.test_jaccard import plain
from tests.llm.test_native import lower
from tidemark.llm import bpe, decontam, langid
from tidemark.llm.queries import tokenizer_path
from tidemark.llm.tables import kept, table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = table(spark, SF, "documents")
    # ties, repeats, odd texts
    odd = [(900, None), (901, ""), (902, "12 34"), (903, "qzx " * 300), (904, "The and of THE and of the"), (905, "the and of the and of the")]
    odd += [(906, "the  and of the and of the"), (905, "the and of the and of the")]
    more = spark.createDataFrame([(i, t, None if i == 903 else "en", "s", 1) for i, t in odd], docs.schema)
    docs = kept(docs.unionByName(more.union(docs.limit(3))), "odd-documents")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(kept(stage(spark, out[-1], SF), "stage"))
    return out


def rows(df):
    return sorted((r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect())


def test_columns(stages):
    assert all(df.schema == stages[0].schema for df in stages[1:-1])


def test_language(spark, stages):
    before, after = rows(stages[0]), rows(stages[1])
    model = langid.train(stages[0])
    assert after == [r for r in before if model.judge([r[1]])[3][0]]
    assert {i for i, _ in before} - {i for i, _ in after} == {900, 901, 902, 903}


def test_exact(stages):
    best = {}
    for i, text in rows(stages[1]):
        best[lower(text)] = max(best.get(lower(text), (i, text)), (i, text))
    assert rows(stages[2]) == sorted(best.values())
    assert len(best) < stages[1].count()


def test_near(stages):
    before = rows(stages[2])
    near = plain(before, corpus_pipeline.NEAR_SHINGLE, corpus_pipeline.NEAR_SIMILAR)
    stays = {i for i, n, c in near if i == c or n == 0}
    assert rows(stages[3]) == [r for r in before if r[0] in stays]


def test_decontamination(spark, stages):
    items = [decontam.split_item(r.text) for r in table(spark, SF, "benchmark").collect()]
    before = rows(stages[3])
    want = [r for r in before if not any(overlap(q, r[1]) >= decontam.OVERLAP for q, _ in items)]
    assert rows(stages[4]) == want
    assert len(want) < len(before)


def test_ids(stages):
    library = bpe.load(tokenizer_path())
    want = sorted((i, library.encode(t, add_special_tokens=False).ids) for i, t in rows(stages[4]))
    import numpy as np

    assert sorted((r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in stages[5].collect()) == want


def test_run(spark, stages):
    assert corpus_pipeline.run(spark, SF).count() > 100

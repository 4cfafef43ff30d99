"""A worker's next task does not find what another operator's left there."""

from __future__ import annotations

import pyarrow as pa
import pytest

from tidemark.llm import bpe, jaccard
from tidemark.llm.queries import tokenizer_path


class Rows:
    """Keeps the function that a stage would run in its workers."""

    def mapInArrow(self, run, schema):
        self.run = run


def batch():
    return pa.record_batch([pa.array([1, 2]), pa.array(["some words of a text", None])], ["doc_id", "text"])


@pytest.fixture
def coder():
    bpe.coder_of.cache_clear()
    return bpe.coder_of(tokenizer_path())


def test_coder_is_let_go_by_another_operator(coder):
    rows = Rows()
    jaccard.sizes(rows)
    text = batch().column("text").fill_null("")
    assert sum(b.num_rows for b in rows.run(iter([pa.record_batch([batch().column("doc_id"), text], ["doc_id", "text"])]))) == 2
    assert bpe.coder_of.cache_info().currsize == 0


def test_coder_stays_for_its_own_tasks(coder):
    run = bpe._encoder(tokenizer_path())
    for _ in range(2):
        assert sum(b.num_rows for b in run(iter([batch()]))) == 2
    assert bpe.coder_of(tokenizer_path()) is coder
    assert coder.seen

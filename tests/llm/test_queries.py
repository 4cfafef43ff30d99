"""Every query of the package runs; those with SQL agree with it."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.compare import connect, difference
from tidemark.llm import oracle
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(oracle.SQL) <= set(QUERIES)
    assert {int(name[2:].split("_")[0]) for name in QUERIES} == set(range(1, 14))


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    got = QUERIES[name](spark, SF).toPandas()
    if name in oracle.SQL:
        assert difference(got, connect(SF).execute(oracle.SQL[name]).df()) is None
    else:
        assert len(got) > 0

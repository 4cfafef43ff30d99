from __future__ import annotations

from pathlib import Path

import pytest

from tidemark import session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session.local(
        8,
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield session.prepare(spark)
    session.clear_scratch(spark)
    root = Path(spark.conf.get("spark.checkpoint.dir"))
    assert not list(root.glob("tidemark-*"))
    spark.stop()


@pytest.fixture
def app(spark, tmp_path):
    from tidemark.plans.app import App

    return App(spark, str(tmp_path / "app"))

from __future__ import annotations

import os
from types import SimpleNamespace

import pytest

from tidemark import session


class Conf(dict):
    def set(self, key, value):
        self[key] = value


def fake(master, **conf):
    return SimpleNamespace(conf=Conf(conf), sparkContext=SimpleNamespace(master=master))


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://x"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(session.NoSharedFolder):
        session.scratch_root(fake(master))
    assert session.scratch_root(fake(master, **{"spark.checkpoint.dir": "hdfs://x/y/"})) == "hdfs://x/y"


@pytest.mark.parametrize("master", ["local", "local[*]", "local[2]"])
def test_a_local_driver_gets_a_temporary_one(master):
    spark = fake(master)
    root = session.scratch_root(spark)
    assert os.path.isdir(root) and session.scratch_root(spark) == root


def test_scratch_is_cleared(spark):
    path = session.scratch_path(spark, "x")
    spark.range(3).write.parquet(path)
    assert session.clear_scratch(spark) >= 1
    assert not os.path.exists(path) and session.clear_scratch(spark) == 0

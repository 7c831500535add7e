from __future__ import annotations

from types import SimpleNamespace

import pytest

from saleswh.session import SETTINGS, shared_dir


def test_settings_are_in_force(spark):
    assert {key: spark.conf.get(key) for key in SETTINGS} == SETTINGS


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")


def _session(master, checkpoint=None):
    context = SimpleNamespace(
        master=master,
        getConf=lambda: {},
        getCheckpointDir=lambda: checkpoint,
    )
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: default))


def test_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(_session("yarn"))
    assert shared_dir(_session("yarn", "hdfs:///c")) == "hdfs:///c"


def test_finer_shuffles_are_put_back(spark):
    from saleswh.session import finer_shuffles

    names = ["spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes"]
    before = [spark.conf.get(name, None) for name in names]
    with finer_shuffles(spark, 96):
        assert spark.conf.get(names[0]) == "96" and spark.conf.get(names[1]) == f"{32 << 20}b"
    assert [spark.conf.get(name, None) for name in names] == before

from __future__ import annotations

from types import SimpleNamespace

import pytest

from headway.session import scratch_path


def session(master: str, setting: str | None = None) -> SimpleNamespace:
    """As much of a session as names a folder."""
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
    settings = {"spark.checkpoint.dir": setting, "spark.sql.warehouse.dir": "file:/warehouse"}
    conf = SimpleNamespace(get=lambda name, default=None: settings[name] or default)
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_the_cluster_names_the_folder(spark):
    first, second = (scratch_path(session("yarn", "hdfs://shared/dir/"), "raw") for _ in range(2))
    assert first.startswith("hdfs://shared/dir/headway/raw-") and first != second
    assert scratch_path(spark, "raw").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_a_cluster_without_a_folder_is_an_error():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(session("yarn"), "raw")


def test_a_local_master_falls_back_to_the_warehouse():
    local = session("local[2]")
    first, second = scratch_path(local, "raw"), scratch_path(local, "raw")
    assert first.startswith("file:/warehouse/headway/raw-") and first != second

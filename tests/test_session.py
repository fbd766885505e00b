from __future__ import annotations

import os

import pytest

from claimscale import session
from claimscale.sources.staging import fresh_path, stage_folder


def test_shuffles_grow_with_the_input(spark):
    before = session.shuffle_width(spark)
    try:
        assert session.size_shuffles(spark, 1) == before
        assert session.size_shuffles(spark, 10 * 1024**3) == 80
        assert session.shuffle_width(spark) == 80
        assert session.size_shuffles(spark, 1024**3) == 80
    finally:
        spark.conf.unset(session.INITIAL_PARTITIONS)
    assert session.shuffle_width(spark) == before


def test_paths_lie_in_the_applications_own_folder(spark):
    a, b = fresh_path(spark, "x"), fresh_path(spark, "x")
    assert a != b
    assert a.startswith(stage_folder(spark) + "/")
    assert stage_folder(spark).endswith(spark.sparkContext.applicationId)


class Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" else default


class Context:
    def __init__(self, master):
        self.master, self.applicationId = master, "app-1"


class Session:
    def __init__(self, master, folder):
        self.conf, self.sparkContext = Conf(folder), Context(master)


def test_shared_folder():
    assert session.shared_folder(Session("yarn", "hdfs:///x/")) == "hdfs:///x"
    with pytest.raises(RuntimeError):
        session.shared_folder(Session("yarn", None))
    local = session.shared_folder(Session("local[2]", None))
    assert local.startswith("file:///")
    assert os.path.isdir(local.removeprefix("file://"))
    assert session.shared_folder(Session("local[2]", None)) == local


def test_clearing_removes_only_the_stage_folder(spark, monkeypatch):
    from claimscale.sources import staging

    kept = staging.stage(spark.range(3))
    own = staging.fresh_path(spark, "own-folder")
    monkeypatch.setattr(staging, "stage_folder", lambda _: own)
    gone = staging.stage(spark.range(5))
    path = os.path.dirname(gone.inputFiles()[0])
    assert gone.count() == 5
    staging.clear_stages(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    assert kept.count() == 3

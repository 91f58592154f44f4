"""The shared folder of a cluster, named with and without its file system."""

import os
from types import SimpleNamespace

import pytest

from clinlake import session


class _OnCluster:
    """The session's context, as a cluster would show it."""

    master = "spark://head:7077"

    def __init__(self, context):
        self._context = context

    def __getattr__(self, name):
        return getattr(self._context, name)


def _cluster(spark, folder):
    return SimpleNamespace(sparkContext=_OnCluster(spark.sparkContext), conf=SimpleNamespace(get=lambda name, default=None: folder))


def test_a_plain_folder_lies_on_the_default_file_system(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "_QUALIFIED", {}, raising=False)
    folder = str(tmp_path / "shared")
    assert session.shared_dir(_cluster(spark, folder)) == f"file:{folder}"
    assert os.listdir(f"{folder}/clinlake") == []  # the mark is gone
    assert session.shared_dir(_cluster(spark, "file:///given")) == "file:///given"


def test_a_folder_that_executors_do_not_see_is_refused(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "_QUALIFIED", {}, raising=False)
    seen = SimpleNamespace(collect=lambda: [True, False])
    cluster = _cluster(spark, str(tmp_path))
    cluster.sparkContext.parallelize = lambda *a: SimpleNamespace(map=lambda f: seen)
    with pytest.raises(RuntimeError, match="executors do not share"):
        session.shared_dir(cluster)

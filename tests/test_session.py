"""Session guard rails: shared checkpoint folder."""

import pytest

from tidemark.session import checkpoint_dir


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" else default


class _SC:
    def __init__(self, master, configured=None):
        self.master, self._configured, self._dir = master, configured, None

    def getCheckpointDir(self):
        return self._dir

    def getConf(self):
        return _Conf(self._configured)

    def setCheckpointDir(self, d):
        self._dir = d


class _Spark:
    def __init__(self, sc):
        self.sparkContext = sc


def test_cluster_without_checkpoint_dir_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(_Spark(_SC("yarn")))


def test_configured_checkpoint_dir_wins():
    assert checkpoint_dir(_Spark(_SC("yarn", "hdfs:///shared/ckpt"))) == "hdfs:///shared/ckpt"

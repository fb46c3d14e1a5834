"""Shared scratch folder rules: read spark.checkpoint.dir; set one only in local mode."""

import pytest

from tidemark.session import checkpoint_root


class _Conf:
    def __init__(self, values):
        self.values = dict(values)

    def get(self, key, default=None):
        return self.values.get(key, default)

    def set(self, key, value):
        self.values[key] = value


class _Session:
    """Stand-in without a SparkContext (as under Spark Connect)."""

    def __init__(self, values):
        self.conf = _Conf(values)

    @property
    def sparkContext(self):
        raise RuntimeError("no SparkContext")


def test_configured_dir_is_used():
    assert checkpoint_root(_Session({"spark.checkpoint.dir": "hdfs:///shared/ckpt/"})) == "hdfs:///shared/ckpt"


def test_cluster_without_dir_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir is not set"):
        checkpoint_root(_Session({"spark.master": "spark://cluster:7077"}))


def test_local_without_dir_gets_a_temp_folder():
    session = _Session({"spark.master": "local[2]"})
    root = checkpoint_root(session)
    assert "tidemark-ckpt-" in root and session.conf.get("spark.checkpoint.dir") == root


def test_real_session_reports_its_dir(spark):
    assert checkpoint_root(spark).startswith("file:") or checkpoint_root(spark).startswith("/")

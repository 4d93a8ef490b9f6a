"""Checkpoint-folder policy: read from the session; a private temporary folder
only for local mode; a cluster session without the setting is an error."""

import pytest

from stocktake.session import checkpoint_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, current=None):
        self.master = master
        self.current = current
        self.set_to = None

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, path):
        self.set_to = self.current = path


class _Session:
    def __init__(self, master, current=None, conf=None):
        self.sparkContext = _Context(master, current)
        self.conf = _Conf(conf or {})


def test_uses_the_sessions_folder():
    s = _Session("yarn", current="hdfs://nn/ckpt")
    assert checkpoint_dir(s) == "hdfs://nn/ckpt" and s.sparkContext.set_to is None


def test_reads_the_configured_folder():
    s = _Session("k8s://x", conf={"spark.checkpoint.dir": "s3a://bucket/ckpt"})
    assert checkpoint_dir(s) == "s3a://bucket/ckpt"


def test_cluster_without_setting_fails():
    with pytest.raises(RuntimeError):
        checkpoint_dir(_Session("yarn"))


def test_local_without_setting_gets_private_folder():
    s = _Session("local[4]")
    path = checkpoint_dir(s)
    assert path and s.sparkContext.set_to == path

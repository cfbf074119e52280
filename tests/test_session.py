"""Session sizing and the shared scratch folder."""

from __future__ import annotations

import pytest

from meteora.session import cluster_conf, ensure_checkpoint_dir, scratch_path


def test_cluster_conf_sizes_for_100_tb():
    conf = cluster_conf(100 << 40)
    assert int(conf["spark.sql.shuffle.partitions"]) == (100 << 40) // 10 // (256 << 20)
    assert conf["spark.sql.files.maxPartitionBytes"] == str(1 << 30)
    assert conf["spark.sql.adaptive.enabled"] == "true" and conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert conf["spark.sql.adaptive.coalescePartitions.parallelismFirst"] == "false"
    assert conf["spark.sql.parquet.compression.codec"] == "zstd"
    # no broadcast on estimates; runtime broadcast on measured stages only
    assert conf["spark.sql.autoBroadcastJoinThreshold"] == "-1"
    assert conf["spark.sql.adaptive.autoBroadcastJoinThreshold"] == "32m"
    # small inputs keep a floor of partitions for AQE to coalesce
    assert int(cluster_conf(1 << 30)["spark.sql.shuffle.partitions"]) == 200


def test_scratch_is_below_the_checkpoint_dir_and_unique(spark):
    base = spark.conf.get("spark.checkpoint.dir").rstrip("/")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(base + "/") and b.startswith(base + "/") and a != b


class _Conf:
    def __init__(self, values):
        self.values = dict(values)

    def get(self, key, default=None):
        return self.values.get(key, default)

    def set(self, key, value):
        self.values[key] = value


class _Context:
    def __init__(self, master, checkpoint_dir=None):
        self.master, self.dir = master, checkpoint_dir

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, d):
        self.dir = d


class _Session:
    def __init__(self, master, conf=None, checkpoint_dir=None):
        self.conf, self.sparkContext = _Conf(conf or {}), _Context(master, checkpoint_dir)


def test_cluster_session_needs_a_shared_checkpoint_dir():
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_Session("yarn"))


def test_cluster_checkpoint_dir_is_read_from_the_session():
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs://nn/shared/ckpt"})
    assert ensure_checkpoint_dir(s) == "hdfs://nn/shared/ckpt"
    assert s.sparkContext.getCheckpointDir() == "hdfs://nn/shared/ckpt"


def test_local_session_without_one_gets_a_folder():
    s = _Session("local[2]")
    d = ensure_checkpoint_dir(s)
    assert d and s.conf.get("spark.checkpoint.dir") == d and s.sparkContext.getCheckpointDir() == d


class _SubmittedConf:
    def __init__(self, keys):
        self.keys = set(keys)

    def contains(self, key):
        return key in self.keys


def test_base_conf_fills_what_the_submitter_left_unset():
    from meteora.session import BASE_CONF, unset_base_conf

    submitted = {"spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.ui.enabled"}
    unset = unset_base_conf(_SubmittedConf(submitted))
    assert set(unset) == set(BASE_CONF) - submitted  # --conf wins
    assert unset["spark.sql.autoBroadcastJoinThreshold"] == "-1"
    assert unset["spark.python.sql.dataFrameDebugging.enabled"] == "false"


def test_submit_flags_for_an_input_size():
    from meteora.session import parse_size, submit_flags

    assert parse_size("100T") == 100 << 40 and parse_size("750g") == 750 << 30 and parse_size("12345") == 12345
    flags = submit_flags(parse_size("100T"))
    assert f"--conf spark.sql.shuffle.partitions={(100 << 40) // 10 // (256 << 20)}" in flags
    assert "--conf spark.sql.autoBroadcastJoinThreshold=-1" in flags

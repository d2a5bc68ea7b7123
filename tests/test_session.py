import pytest

from lodestar.session import ensure_checkpoint_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, conf):
        self.master, self._conf, self.dir = master, _Conf(conf), None

    def getCheckpointDir(self):
        return self.dir

    def getConf(self):
        return self._conf

    def setCheckpointDir(self, path):
        self.dir = path


class _Session:
    def __init__(self, master, conf):
        self.sparkContext = _Context(master, conf)
        self.conf = _Conf(conf)


def test_cluster_without_checkpoint_dir_is_an_error():
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_Session("yarn", {}))


def test_cluster_uses_configured_shared_folder():
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs://nn/ckpt"})
    assert ensure_checkpoint_dir(s) == "hdfs://nn/ckpt"


def test_local_without_setting_gets_scratch_folder():
    s = _Session("local[2]", {})
    assert ensure_checkpoint_dir(s).startswith("/")


def test_test_session_reads_its_setting(spark):
    assert ensure_checkpoint_dir(spark)


def test_scale_conf_sizes_partitions():
    from lodestar.session import scale_conf
    big = scale_conf(100 * (1 << 40), cores=8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * (1 << 40) // (256 << 20)
    small = scale_conf(1 << 20, cores=8)
    assert small["spark.sql.shuffle.partitions"] == "16"
    assert small["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_apply_scale_conf_on_session(spark):
    from lodestar.session import apply_scale_conf
    keys = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.skewJoin.enabled",
            "spark.sql.files.maxPartitionBytes"]
    before = {k: spark.conf.get(k) for k in keys}
    try:
        conf = apply_scale_conf(spark, 10 << 30, cores=4)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "40"
        assert conf["spark.sql.shuffle.partitions"] == "40"
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)

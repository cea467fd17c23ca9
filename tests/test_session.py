"""Session profile (TR14) and scratch folders."""

import os

import pytest

from geonest import session as S


class FakeSession:
    """What build_session asks of a session on some master."""

    def __init__(self, master, chosen=()):
        self.sparkContext = self
        self.master, self.defaultParallelism, self.applicationId = master, 8, "app"
        self._chosen, self.set_to = dict(chosen), {}
        self.conf = self

    def getConf(self):
        return self

    def getAll(self):
        return list(self._chosen.items())

    def get(self, key, default=None):
        return self._chosen.get(key, default)

    def isModifiable(self, key):
        return key.startswith("spark.sql.") and "warehouse" not in key

    def set(self, key, value):
        self.set_to[key] = value


@pytest.mark.parametrize("master,cluster", [("local[4]", False), ("local", False), ("local-cluster[3,2,1024]", True), ("yarn", True), ("k8s://x", True)])
def test_cluster_profile_follows_the_live_master(master, cluster):
    s = FakeSession(master)
    S.build_session(spark=s)
    assert (S.CLUSTER_PROFILE.items() <= s.set_to.items()) == cluster
    assert S.PROFILE.items() <= s.set_to.items()


def test_submitted_settings_win_and_static_ones_are_skipped():
    key = "spark.sql.files.maxPartitionBytes"
    s = FakeSession("yarn", {key: "16m"})
    S.build_session(spark=s, conf={"spark.sql.warehouse.dir": "/w", "spark.sql.shuffle.partitions": "7"})
    assert key not in s.set_to and "spark.sql.warehouse.dir" not in s.set_to and s.set_to["spark.sql.shuffle.partitions"] == "7"


def test_static_settings_on_a_live_session(spark):
    before = spark.conf.get("spark.sql.warehouse.dir")
    S.build_session(spark=spark, conf={"spark.sql.warehouse.dir": "/elsewhere"})
    assert spark.conf.get("spark.sql.warehouse.dir") == before


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        S.checkpoint_root(FakeSession("yarn"))


def test_scratch_names_make_no_folder(spark):
    path = S.new_scratch_dir(spark, "name")
    assert path != S.new_scratch_dir(spark, "name") and not os.path.exists(path.replace("file:", ""))


def test_a_cluster_task_gets_what_it_can_sort():
    # compressed bytes; sorted rows take up to 17 times as much
    sizes = {k: int(v.rstrip("m")) for k, v in S.CLUSTER_PROFILE.items() if v.endswith("m")}
    assert sizes["spark.sql.adaptive.advisoryPartitionSizeInBytes"] <= 64 and sizes["spark.sql.files.maxPartitionBytes"] <= 128

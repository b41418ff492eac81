from __future__ import annotations

from types import SimpleNamespace

import pytest

from tidemark import scratch


class Settings(dict):
    def get(self, key, default=None):
        return super().get(key, default)


def session(master: str, **settings):
    return SimpleNamespace(conf=Settings(settings), sparkContext=SimpleNamespace(master=master, applicationId=f"app-{master}"))


def test_the_cluster_setting_is_used():
    spark = session("yarn", **{scratch.CHECKPOINT_DIR: "hdfs://shared/dir/"})
    assert scratch.shared_dir(spark) == "hdfs://shared/dir"
    first, second = scratch.new_dir(spark, "t"), scratch.new_dir(spark, "t")
    assert first.startswith("hdfs://shared/dir/tidemark/t-") and first != second


def test_a_cluster_without_the_setting_is_refused():
    with pytest.raises(RuntimeError, match=scratch.CHECKPOINT_DIR):
        scratch.shared_dir(session("spark://host:7077"))


def test_local_mode_gets_one_folder():
    spark = session("local[2]")
    assert scratch.shared_dir(spark) == scratch.shared_dir(spark)

"""The shared folder."""

import types

import pytest

from wavelake.session import is_local, shared_dir


class Context:
    """A context of a cluster whose checkpoint folder is unset."""

    master = "spark://host:7077"
    _jsc = types.SimpleNamespace(sc=lambda: types.SimpleNamespace(getCheckpointDir=lambda: types.SimpleNamespace(isDefined=lambda: False)))

    def getConf(self):
        return {}


def test_a_cluster_must_name_the_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(types.SimpleNamespace(sparkContext=Context(), conf={}))


def test_local_masters():
    assert is_local("local") and is_local("local[4]") and not is_local("local-cluster[3,2,1000]") and not is_local("yarn")

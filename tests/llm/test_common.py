import os

import pytest

from sitegrain.llm import common


def test_workspaces_are_cleared(spark):
    common.clear()
    work = common.Workspace(spark, "t")
    assert work.write(spark.range(3), "a").count() == 3
    path = work.path.removeprefix("file://")
    assert os.path.isdir(path)
    common.clear()
    assert not os.path.exists(path) and not common.Workspace.made


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        get = staticmethod(lambda *_: None)

    class Context:
        master = "spark://somewhere:7077"
        getConf = staticmethod(lambda: Conf)

    class Session:
        conf, sparkContext = Conf, Context

    with pytest.raises(RuntimeError):
        common.shared_folder(Session)
    Context.master = "local[2]"
    assert common.shared_folder(Session).startswith("file:///")

from types import SimpleNamespace

import pytest

from pagemill.session import cut_lineage, new_workspace, shared_dir


def session(master, folder):
    context = SimpleNamespace(master=master, applicationId=f"app-{master}")
    return SimpleNamespace(conf=SimpleNamespace(get=lambda name, default: folder), sparkContext=context)


def test_the_named_folder_is_used():
    assert shared_dir(session("yarn", "hdfs:///shared/")) == "hdfs:///shared"


def test_only_a_local_session_gets_its_own_folder():
    local = session("local[2]", None)
    assert shared_dir(local) == shared_dir(local)
    assert new_workspace(local, "x") != new_workspace(local, "x")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(session("yarn", None))


def test_cut_lineage(spark):
    cut = cut_lineage(spark.range(10).selectExpr("id * 2 AS n"))
    assert "Range" not in cut._jdf.queryExecution().optimizedPlan().toString()
    assert cut.count() == 10

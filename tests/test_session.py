"""The scratch folder: the session's where it names one."""

from types import SimpleNamespace

import pytest

from tidemark.session import scratch_path


def session(master, **conf):
    return SimpleNamespace(
        conf=SimpleNamespace(get=conf.get), sparkContext=SimpleNamespace(master=master)
    )


def test_named_folder_is_used():
    named = session("yarn", **{"spark.checkpoint.dir": "hdfs:///shared/"})
    path = scratch_path(named, "x")
    assert path.startswith("hdfs:///shared/tidemark/x-")
    assert path != scratch_path(named, "x")


def test_cluster_must_name_it():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(session("spark://master:7077"), "x")


def test_local_session_may_leave_it_out():
    one, other = (scratch_path(session("local[2]"), "x") for _ in range(2))
    assert one.rsplit("/", 1)[0] == other.rsplit("/", 1)[0]
    assert one != other

from __future__ import annotations

import pytest

from millrace import workspace
from millrace.session import build_session, shuffle_settings


@pytest.mark.parametrize(
    ("size", "tasks"),
    [(0, "8"), (100 * 1024**3, "400"), (100 * 10**12, "372530")],
)
def test_shuffle_tasks_grow_with_the_data(size, tasks):
    assert shuffle_settings(size)["spark.sql.shuffle.partitions"] == tasks


def test_session_keeps_the_master(spark):
    session = build_session("other", {"spark.millrace.test": "x"})
    assert session.sparkContext.master == spark.sparkContext.master
    assert session.conf.get("spark.sql.adaptive.enabled") == "true"


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Conf:
        def __init__(self, master):
            self.master = master

        def get(self, name, default=None):
            return self.master if name == "spark.master" else default

    class Session:
        def __init__(self, master):
            self.conf = Conf(master)

    monkeypatch.setattr(workspace, "_named_dir", None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        workspace.shared_dir(Session("yarn"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        workspace.shared_dir(Session("local[2]"))
    workspace.use_folder("/shared/here/")
    assert workspace.shared_dir(Session("local[2]")) == "/shared/here"

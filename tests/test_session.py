from __future__ import annotations

from types import SimpleNamespace

import pytest

from rollmart import session


def fake(folder, master):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: folder if key == "spark.checkpoint.dir" else default),
        sparkContext=SimpleNamespace(master=master),
    )


def test_the_folder_of_the_cluster_is_used():
    assert session.shared_folder(fake("hdfs:///shared/", "yarn")) == "hdfs:///shared"


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(fake(None, "yarn"))


def test_a_local_session_gets_one_folder():
    assert session.shared_folder(fake(None, "local[2]")) == session.shared_folder(fake(None, "local[2]"))

"""The shared folder: taken from the session, made only for a local master."""

import pytest

from larder.session import CHECKPOINT_CONF, scratch_path, settle, shared_dir


class Session:
    """Stands for a session with the given setting and master."""

    def __init__(self, setting, master):
        self.setting, self.master, self.folder = setting, master, None
        self.conf, self.sparkContext = self, self

    def get(self, name, default):
        assert name == CHECKPOINT_CONF
        return self.setting or default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_the_named_folder_is_used():
    assert shared_dir(Session("s3a://b/ck/", "yarn")) == "s3a://b/ck"


def test_a_cluster_without_a_folder_is_refused():
    with pytest.raises(RuntimeError):
        shared_dir(Session(None, "yarn"))


def test_a_local_master_gets_one_folder():
    session = Session(None, "local[2]")
    assert shared_dir(session) == shared_dir(session) == session.folder


def test_settled_frames_are_read_from_the_folder(spark):
    assert scratch_path(spark, "x").startswith(f"{shared_dir(spark)}/larder/x-")
    copy = settle(spark.range(5))
    assert "FileScan parquet" in copy._jdf.queryExecution().executedPlan().toString()
    assert copy.count() == 5

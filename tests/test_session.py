from types import SimpleNamespace

import pytest

from keyfold.session import shared_dir


class RemoteSession:
    """A session whose context lives on a server: no SparkContext here."""

    conf = SimpleNamespace(get=lambda key, default=None: default)

    @property
    def sparkContext(self):
        raise RuntimeError("not available")


def test_no_local_folder_for_a_remote_session():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(RemoteSession())


def test_session_sets_a_folder_in_local_mode(spark):
    assert shared_dir(spark) == shared_dir(spark) != ""

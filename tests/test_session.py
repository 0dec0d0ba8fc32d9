"""The shared scratch folder."""

from types import SimpleNamespace

import pytest

from estratos.session import scratch_path, scratch_root


class Session:
    """As much of a session as the scratch folder asks for."""

    def __init__(self, master, folder=None):
        self.conf = SimpleNamespace(get=lambda key, default=None: default)
        own = SimpleNamespace(get=lambda key, default=None: folder)
        self.sparkContext = SimpleNamespace(master=master, applicationId=f"app-{master}", getConf=lambda: own)


def test_the_folder_the_cluster_names_is_used():
    session = Session("spark://host:7077", "s3a://bucket/scratch/")
    assert scratch_root(session) == "s3a://bucket/scratch"
    assert scratch_path(session, "x").startswith("s3a://bucket/scratch/estratos/x-")


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "k8s://x", "local-cluster[3,2,1024]"])
def test_a_cluster_without_a_folder_is_an_error(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(Session(master))


@pytest.mark.parametrize("master", ["local", "local[*]", "local[8]", "local[4,2]"])
def test_one_process_gets_a_folder_of_its_own(master):
    session = Session(master)
    assert scratch_root(session) == scratch_root(session) != ""

"""The shared folder of a session."""

from types import SimpleNamespace

import pytest

from genoframe.plans.shared import shared_folder, shared_path


def fake_session(master: str, configured: str | None):
    made = []
    context = SimpleNamespace(
        master=master,
        getCheckpointDir=lambda: made[-1] if made else None,
        setCheckpointDir=made.append,
    )
    conf = SimpleNamespace(get=lambda key, default: configured or default)
    return SimpleNamespace(sparkContext=context, conf=conf)


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[3,2,1000]"])
def test_cluster_without_folder_is_refused(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(fake_session(master, None))


@pytest.mark.parametrize("master", ["yarn", "local[4]"])
def test_configured_folder_is_used(master):
    assert shared_folder(fake_session(master, "hdfs:///scratch")) == "hdfs:///scratch"


def test_local_session_gets_a_folder():
    session = fake_session("local[2]", None)
    assert shared_folder(session) == session.sparkContext.getCheckpointDir()


def test_paths_are_new_and_inside(spark):
    first, second = shared_path(spark, "run"), shared_path(spark, "run")
    assert first != second
    assert first.startswith(f"{shared_folder(spark)}/run-")

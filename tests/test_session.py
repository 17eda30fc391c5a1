"""The shared scratch folder."""

from types import SimpleNamespace

import pytest

from harkline.session import scratch_dir, tables_dir


def fake(master, named=None):
    folder = []
    context = SimpleNamespace(
        master=master, getCheckpointDir=lambda: folder[-1] if folder else None, setCheckpointDir=folder.append
    )
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: named))


def test_the_named_folder_is_used():
    assert scratch_dir(fake("spark://host:7077", "hdfs:///shared")) == "hdfs:///shared"


def test_a_cluster_must_name_a_folder():
    for master in ("spark://host:7077", "local-cluster[2,1,1024]", "yarn"):
        with pytest.raises(ValueError):
            scratch_dir(fake(master))


def test_local_mode_falls_back_to_a_temporary_folder():
    session = fake("local[2]")
    assert scratch_dir(session) == scratch_dir(session)


def test_our_sessions_name_a_folder(spark):
    assert spark.conf.get("spark.checkpoint.dir") in scratch_dir(spark)


def test_tables_lie_in_the_folder(spark):
    assert tables_dir(spark).startswith(scratch_dir(spark))

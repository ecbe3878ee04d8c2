"""Tables kept between steps: where they are, and that they go."""

import os

import pytest

from rollcall import sinks


class Cluster:
    """A session on a cluster, as far as the folder is concerned."""

    def __init__(self, **conf):
        self.sparkContext, self.master, self.applicationId, self.conf = self, "spark://host:7077", "app-1", conf

    def getConf(self):
        return self.conf


def files(path):
    return os.listdir(path.removeprefix("file://")) if os.path.isdir(path.removeprefix("file://")) else []


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        sinks.shared_path(Cluster())
    for master in ("local-cluster[3,2,1024]", "yarn"):
        session = Cluster()
        session.master = master
        with pytest.raises(RuntimeError):
            sinks.shared_folder(session)
    named = Cluster(**{"spark.checkpoint.dir": "hdfs://x/y/"})
    assert sinks.shared_path(named).startswith("hdfs://x/y/")


def test_a_run_takes_its_folder_with_it(spark):
    with sinks.run_folder(spark) as outer:
        kept = sinks.staged(spark.range(10))
        with sinks.run_folder(spark) as inner:
            assert inner.startswith(f"{outer}/")
            assert sinks.staged(spark.range(5)).count() == 5
            assert len(files(inner)) == 1
        assert files(inner) == [] and kept.count() == 10
        assert len(files(outer)) == 1
    assert files(outer) == []
    assert not sinks.shared_path(spark).startswith(outer)


def test_the_folder_goes_after_an_error_too(spark):
    with pytest.raises(ValueError), sinks.run_folder(spark) as folder:
        sinks.staged(spark.range(3))
        raise ValueError
    assert files(folder) == []


def test_what_is_kept_reads_as_it_was(spark, rows):
    df = spark.createDataFrame([(1, "a", None), (2, None, 0.5)], "k int, t string, x double")
    with sinks.run_folder(spark):
        again = sinks.staged(df)
        assert again.schema == df.schema and rows(again) == rows(df)

from types import SimpleNamespace

import pytest

from tollhouse.llm.common import removed, shared_folder, written


class Context:
    """A session's context without a folder."""

    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):  # noqa: N802
        return self.folder

    def setCheckpointDir(self, folder):  # noqa: N802
        self.folder = folder


def session(master, folder=None):
    return SimpleNamespace(sparkContext=Context(master), conf=SimpleNamespace(get=lambda name, default=None: folder or default))


def test_a_cluster_needs_a_shared_folder():
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_folder(session(master))
        assert shared_folder(session(master, "s3://a/b")) == "s3://a/b"
    assert shared_folder(session("local[4]")) and shared_folder(session("local"))


def test_written_tables_and_their_removal(spark, tmp_path):
    df = spark.createDataFrame([(1, [2, None]), (3, None)], "a long, b array<int>")
    again = written(df)
    assert again.schema == df.schema and sorted(map(str, again.collect())) == sorted(map(str, df.collect()))
    df.write.parquet(str(tmp_path / "x"))
    removed(spark, str(tmp_path / "x"))
    assert not (tmp_path / "x").exists()

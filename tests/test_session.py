import pytest

from gameflow.session import scratch_folders, scratch_path, scratch_root


class Settings:
    def __init__(self, **values):
        self.conf = self
        self.values = {"spark.app.id": "app", **values}

    def get(self, key, default=None):
        return self.values.get(key, default)


def test_scratch_folder_is_the_one_the_cluster_names():
    assert scratch_root(Settings(**{"spark.master": "yarn", "spark.checkpoint.dir": "hdfs:///c/"})) == "hdfs:///c"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(Settings(**{"spark.master": "spark://host:7077"}))
    local = Settings(**{"spark.master": "local[2]"})
    assert scratch_root(local) == scratch_root(local)


def test_scratch_folders_are_deleted_after_use(spark):
    with scratch_folders(spark, "a") as [path]:
        spark.range(3).write.parquet(path)
        assert spark.read.parquet(path).count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    assert scratch_path(spark, "a") != scratch_path(spark, "a")

import os

import pytest

from quarryline import session


def test_a_local_folder_is_rejected_on_a_cluster():
    session.check_shared("file", "local[4]", "/tmp/x")
    session.check_shared("hdfs", "yarn", "hdfs://nn/x")
    for master in ("yarn", "spark://host:7077", "k8s://https://host"):
        with pytest.raises(ValueError):
            session.check_shared("file", master, "/tmp/x")


def test_scratch_folders_go_at_the_end_of_the_block(spark):
    with session.scratch():
        table = session.stage(spark.range(5))
        folder = session._staged[-1][1]
        assert table.count() == 5 and os.path.isdir(folder)
    assert not os.path.exists(folder)


class _Cluster:
    """The session of a cluster: its master is not local, everything else is that of ``spark``."""

    def __init__(self, spark, conf, checkpoint_dir=None):
        self._spark, self._jsc, self._jvm, self.conf = spark, spark._jsc, spark._jvm, conf
        self.range, self.read, self.sparkContext = spark.range, spark.read, self
        self.master, self.applicationId, self.defaultParallelism = "spark://host:7077", str(id(self)), 4
        self.getCheckpointDir = lambda: checkpoint_dir


def test_a_mounted_folder_is_used_on_a_cluster_when_all_rows_come_back(spark, tmp_path):
    shared, warehouse = str(tmp_path / "shared"), str(tmp_path / "warehouse")
    conf = {"spark.checkpoint.dir": f"file://{shared}", "spark.sql.warehouse.dir": warehouse}
    with session.scratch():
        assert session.shared_folder(_Cluster(spark, conf)).startswith(f"file://{shared}/quarryline-")
        del conf["spark.checkpoint.dir"]
        assert session.shared_folder(_Cluster(spark, conf, shared)).startswith(f"{shared}/quarryline-")
        assert session.shared_folder(_Cluster(spark, conf)).startswith(f"{warehouse}/quarryline-")
    assert os.listdir(shared) == os.listdir(warehouse) == []


def test_a_folder_of_one_machine_is_found_out_on_a_cluster(spark, tmp_path, monkeypatch):
    cluster = _Cluster(spark, {"spark.checkpoint.dir": str(tmp_path)})

    class Reader:
        """Sees half of the files, as a driver does whose executors wrote to their own disks."""

        def schema(self, schema):
            return self

        def parquet(self, folder):
            return spark.read.parquet(folder).where("id % 2 = 0")

    monkeypatch.setattr(cluster, "read", Reader())
    with session.scratch(), pytest.raises(ValueError):
        session.shared_folder(cluster)
    monkeypatch.setattr(cluster, "read", spark.read)
    with session.scratch():
        session.shared_folder(cluster)  # nothing was remembered of the refusal


def test_unstaged_tables_are_gone_and_settings_stay(spark, tmp_path, monkeypatch):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    monkeypatch.setattr(session, "_root", lambda _: str(tmp_path))
    kept, gone = [session.stage(spark.range(n).groupBy("id").count()) for n in (5, 7)]
    session.unstage(gone)
    assert kept.count() == 5 and len(os.listdir(tmp_path)) == 1 and spark.conf.get(key) == before

"""The shared folder under masters that a test cannot start."""

import os
from types import SimpleNamespace

import pytest

from __spark_entry__ import SMOKE_DIR, queries
from tidelake.session import scratch_path, shared_dir


class Context:
    """What ``shared_dir`` asks of a Spark context on a machine whose default file system is its own."""

    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder
        self._jsc = SimpleNamespace(hadoopConfiguration=lambda: {"fs.defaultFS": "file:///"})

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = f"file:{folder}/kept"


def session(master, configured=None, folder=None):
    conf = SimpleNamespace(get=lambda key, default=None: configured if key == "spark.checkpoint.dir" else default)
    return SimpleNamespace(sparkContext=Context(master, folder), conf=conf)


def test_bare_checkpoint_folder_serves_a_cluster():
    cluster = session("spark://host:7077", "/mnt/checkpoints", "file:/mnt/checkpoints/4e90")  # as Spark keeps the setting
    assert shared_dir(cluster) == "file:/mnt/checkpoints/4e90"
    assert scratch_path(cluster, "csv").startswith("file:/mnt/checkpoints/4e90/tidelake/csv-")


def test_bare_checkpoint_folder_has_the_scheme_of_the_default_file_system():
    cluster = session("yarn", "/checkpoints", "hdfs://name:8020/checkpoints/4e90")
    assert shared_dir(cluster) == "hdfs://name:8020/checkpoints/4e90"


def test_cluster_without_a_checkpoint_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(session("spark://host:7077"))


def test_temporary_folder_is_the_same_for_every_process(tmp_path, monkeypatch):
    (tmp_path / "own").mkdir()
    (tmp_path / "link").symlink_to(tmp_path / "own")  # stands for /proc/self/cwd, which each process resolves to another place
    monkeypatch.setattr("tempfile.tempdir", str(tmp_path / "link"))
    folder = shared_dir(session("local-cluster[2,2,2000]"))
    assert folder.startswith(f"file:{os.path.realpath(tmp_path)}/own/tidelake-")


#: Queries that write below the shared folder, by the finding that says they failed.
WRITING = [
    "changed_history",  # F2
    "bronze_rejects",  # F3
    "converted_csv",  # F4
    "counted_write",  # F5
    "csv_copy",  # F6
    "csv_texts",  # F7
    "exported_catalog",  # F8
    "curve_layout",  # F9
    "feed_charts",  # F10
    "feed_klines",  # F11
    "feed_filings",  # F12
    "feed_other_quotes",  # F13
    "feed_quotes",  # F14
    "feed_other_charts",  # F15
    "feed_rejects",  # F16
    "feed_series",  # F17
    "feed_spot",  # F18
    "feed_yield_curve",  # F19
    "input_fingerprint",  # F20
    "gold_outputs",  # F21
    "inventory_csv",  # F22
    "json_array_lines",  # F23
]


@pytest.mark.parametrize("name", WRITING)
def test_query_runs_where_the_checkpoint_folder_is_bare(spark, monkeypatch, tmp_path, name):
    get = type(spark.conf).get
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, *rest: (
        str(tmp_path) if key == "spark.checkpoint.dir" else get(self, key, *rest)))
    rows = queries()[name](spark, SMOKE_DIR).collect()
    assert rows or name == "feed_rejects"  # nothing is rejected at that size

"""Payload files through the data source: filters, tasks by size, streams."""

import os

import pytest

from tidelake.sources import payload_source, raw


def put(root, name, text):
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as file:
        file.write(text if isinstance(text, bytes) else text.encode())
    return path


@pytest.fixture()
def lake(spark, tmp_path):
    payload_source.register(spark)
    root = str(tmp_path / "lake")
    put(root, "symbol=A/_raw.json", '{"a": 1}\n{"a": 2}')
    put(root, "symbol=B%2FC/date=2024/_raw_page=1.json", "[]")
    put(root, "symbol=A/note.txt", b"caf\xe9")
    put(root, "symbol=D/_SUCCESS", "")
    put(root, "loose.json", "")
    return root


def rows(frame):
    return {(r["source_key"], r["raw"]) for r in frame.collect()}


def test_same_rows_as_the_plain_reader(spark, lake):
    for options, key in (({}, None), ({"key": "symbol"}, "symbol")):
        found = spark.read.format("payload_files").options(path=lake, **options).load()
        plain = raw.read_payloads(spark, lake).withColumn("source_key", raw.key_of("bronze_path", key))
        assert rows(found) == rows(plain) and found.count() == 4
    assert rows(spark.read.format("payload_files").options(path=lake, key="symbol", name_glob="_raw*").load()) == {
        ("A", '{"a": 1}\n{"a": 2}'), ("B/C", "[]")}


def test_filters_are_decided_before_files_are_opened(spark, lake):
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW lake USING payload_files OPTIONS (path '{lake}', key 'symbol', bytes_per_task '1')")
    tasks = {
        "source_key = 'A'": 2, "source_key IN ('A', 'B/C')": 3, "source_key LIKE 'B%'": 1, "length > 5": 1, "source_key <> 'A'": 2,
        "modified_ms < 0": 1, "source_key = 'A' AND raw LIKE 'c%'": 2, "source_key >= 'B' AND length < 100": 1,
        "source_key = 'none'": 1}
    for condition, expected in tasks.items():
        found = spark.sql(f"SELECT source_key, raw FROM lake WHERE {condition}")
        assert found.rdd.getNumPartitions() == expected, condition
        whole = spark.createDataFrame(spark.table("lake").collect(), payload_source.SCHEMA)
        assert rows(found) == rows(whole.where(condition).select("source_key", "raw")), condition


def test_directories_of_other_keys_are_not_listed(lake, monkeypatch):
    tree = payload_source.Tree(lake, key="symbol")
    listed, selector = [], payload_source.afs.FileSelector
    monkeypatch.setattr(payload_source.afs, "FileSelector", lambda path: listed.append(os.path.basename(path)) or selector(path))
    found = tree.files((payload_source.EqualTo(("source_key",), "A"),))
    assert [f.source_key for f in found] == ["A", "A"] and sorted(listed) == ["lake", "symbol=A"]


def test_tasks_by_size():
    tree = payload_source.Tree("x", bytes_per_task=100_000)
    files = [payload_source.Found("k", f"f{i}", size, 0) for i, size in enumerate([250_000, 60_000, 50_000, 40_000, 10, 10])]
    dealt = [[f.bronze_path for f in t.files] for t in tree.dealt(files)]
    assert dealt == [["f0"], ["f1"], ["f2", "f3", "f4", "f5"]] and sorted(sum(dealt, [])) == [f.bronze_path for f in files]
    many = [payload_source.Found("k", f"f{i}", 0, 0) for i in range(1000)]
    assert max(len(t.files) for t in tree.dealt(many)) <= 25 + 1


def test_empty_and_missing_trees(spark, tmp_path):
    payload_source.register(spark)
    empty = tmp_path / "empty"
    empty.mkdir()
    assert spark.read.format("payload_files").load(str(empty)).count() == 0
    with pytest.raises(Exception, match="nowhere"):
        spark.read.format("payload_files").load(str(tmp_path / "nowhere")).count()


def test_stream_reads_each_version_once(spark, lake, tmp_path):
    def drain():
        stream = spark.readStream.format("payload_files").options(path=lake, key="symbol", log=str(tmp_path / "log")).load()
        query = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).trigger(
            availableNow=True).start(str(tmp_path / "out"))
        assert query.awaitTermination(120)
        return sorted((r["source_key"], r["raw"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())

    first = drain()
    assert len(first) == 4 and drain() == first
    late = put(lake, "symbol=E/_raw.json", "late")
    os.utime(late, (1, 1))  # dated before everything read so far
    put(lake, "symbol=A/_raw.json", "changed now")
    assert drain() == sorted([*first, ("E", "late"), ("A", "changed now")])


def test_entries_survive_a_crash_before_their_batch(spark, lake, tmp_path):
    tree = payload_source.Tree(lake, key="symbol")
    before = payload_source.PayloadStream(tree, str(tmp_path / "log"))
    assert before.latestOffset() == {"entries": 1} == before.latestOffset()
    put(lake, "symbol=Z/_raw.json", "z")
    after = payload_source.PayloadStream(tree, str(tmp_path / "log"))
    assert after.latestOffset() == {"entries": 2}
    keys = lambda a, b: sorted(f.source_key for t in after.partitions({"entries": a}, {"entries": b}) for f in t.files)
    assert keys(0, 1) == ["", "A", "A", "B/C"] and keys(1, 2) == ["Z"] and keys(2, 2) == []

"""Raw payload files as a data source: ``USING payload_files`` in SQL, ``spark.read`` and ``spark.readStream``.

One row per file: ``source_key`` (of its directory), ``bronze_path``, ``length``, ``modified_ms`` and its whole text ``raw``. Filters on all
but ``raw`` are decided from names and sizes alone, before any file is opened, and directories of other keys are not even listed where
the option ``key`` names the directories. Files are dealt to tasks by size.

Names and sizes pass through the planner, as those of Spark's own file sources do; where even names are too many,
``raw.read_payloads`` lists in tasks.
"""

from __future__ import annotations

import fnmatch
import json
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.fs as afs
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In,
    InputPartition, IsNotNull, LessThan, LessThanOrEqual, Not, StringContains, StringEndsWith, StringStartsWith,
)

from tidelake.sources import raw

cloudpickle.register_pickle_by_value(sys.modules[__name__])

NAME = "payload_files"
SCHEMA = "source_key string, bronze_path string, length bigint, modified_ms bigint, raw string"
LISTED = ("source_key", "bronze_path", "length", "modified_ms")
#: Python orders the code points of strings as Spark orders their UTF-8 bytes.
COMPARED = {
    EqualTo: lambda a, b: a == b, EqualNullSafe: lambda a, b: a == b, GreaterThan: lambda a, b: a > b,
    GreaterThanOrEqual: lambda a, b: a >= b, LessThan: lambda a, b: a < b, LessThanOrEqual: lambda a, b: a <= b,
    In: lambda a, b: a in b, StringStartsWith: str.startswith, StringEndsWith: str.endswith, StringContains: str.__contains__,
}


def decidable(condition: Filter) -> bool:
    """Whether names and sizes settle a filter. One with a null value stays with Spark."""
    if isinstance(condition, Not):
        return decidable(condition.child)
    if isinstance(condition, IsNotNull):
        return condition.attribute[0] in LISTED
    if type(condition) not in COMPARED or condition.attribute[0] not in LISTED:
        return False
    return condition.value is not None and not (isinstance(condition, In) and None in condition.value)


def holds(condition: Filter, column: str, value: str | int) -> bool:
    """Whether a filter lets a value of a column pass; filters of other columns do."""
    inner = condition.child if isinstance(condition, Not) else condition
    if inner.attribute[0] != column or isinstance(condition, IsNotNull):
        return True
    found = True if isinstance(inner, IsNotNull) else bool(COMPARED[type(inner)](value, inner.value))
    return found != isinstance(condition, Not)


@dataclass(frozen=True)
class Found:
    source_key: str
    bronze_path: str
    length: int
    modified_ms: int


@dataclass
class Files(InputPartition):
    files: list[Found]


@dataclass(frozen=True)
class Tree:
    """A directory of payload files, or one file."""
    root: str
    name_glob: str = "*"
    key: str | None = None
    bytes_per_task: int = raw.BYTES_PER_TASK

    @staticmethod
    def of(options: dict) -> Tree:
        if "path" not in options:
            raise ValueError("payload_files needs a path")
        return Tree(options["path"], options.get("name_glob", "*"), options.get("key"),
                    int(options.get("bytes_per_task", raw.BYTES_PER_TASK)))

    def key_of(self, path: str) -> str:
        """As ``raw.key_of``: the value of ``key=``, or of the last ``x=`` directory; empty without one."""
        found = re.search(rf"/{re.escape(self.key)}=([^/]+)/", path) if self.key else re.match(r".*/[^/=]+=([^/]+)/[^/]*$", path)
        return unquote(found[1]) if found else ""

    def files(self, filters: tuple[Filter, ...] = ()) -> list[Found]:
        """All files that pass the filters, by path. Directories of keys that fail are not listed."""
        system, top, prefix = raw.located(self.root)
        [info] = system.get_file_info([top])
        if info.type == afs.FileType.NotFound:
            raise FileNotFoundError(self.root)
        waiting, out = [info], []
        while waiting:
            info = waiting.pop()
            name = info.base_name
            if info.type == afs.FileType.Directory:
                if self.key and name.startswith(f"{self.key}=") and info.path != top:
                    value = self.key_of(f"/{name}/")
                    if not all(holds(f, "source_key", value) for f in filters):
                        continue
                waiting += [x for x in system.get_file_info(afs.FileSelector(info.path)) if not raw.MARKERS.match(x.base_name)]
            elif fnmatch.fnmatchcase(name, self.name_glob):
                row = Found(self.key_of(info.path), prefix + info.path, info.size, info.mtime_ns // 1_000_000 if info.mtime_ns else 0)
                if all(holds(f, c, getattr(row, c)) for f in filters for c in LISTED):
                    out.append(row)
        return sorted(out, key=lambda f: f.bronze_path)

    def dealt(self, files: list[Found]) -> list[Files]:
        """Files in tasks of about ``bytes_per_task``, largest first into an open task; a larger file is a task of its own."""
        tasks: list[list[Found]] = []
        room = 0
        for file in sorted(files, key=lambda f: (-f.length, f.bronze_path)):
            if not tasks or file.length > room:
                tasks.append([])
                room = self.bytes_per_task
            tasks[-1].append(file)
            room -= max(file.length, 4096)  # opening a file costs as much as some bytes
        return [Files(t) for t in tasks]


def contents(partition: Files) -> Iterator[pa.RecordBatch]:
    """A batch per file; bytes that are no UTF-8 become U+FFFD."""
    for file in partition.files:
        system, inner, _ = raw.located(file.bronze_path)
        with system.open_input_stream(inner) as stream:
            text = stream.read().decode("utf-8", "replace")
        yield pa.RecordBatch.from_arrays(
            [pa.array([file.source_key]), pa.array([file.bronze_path]), pa.array([file.length], pa.int64()),
             pa.array([file.modified_ms], pa.int64()), pa.array([text], pa.large_string()).cast(pa.string())],
            names=["source_key", "bronze_path", "length", "modified_ms", "raw"])


class PayloadReader(DataSourceReader):
    def __init__(self, tree: Tree):
        self.tree, self.filters = tree, ()

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        self.filters = tuple(f for f in filters if decidable(f))
        yield from (f for f in filters if not decidable(f))

    def partitions(self) -> list[Files]:
        return self.tree.dealt(self.tree.files(self.filters)) or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        return contents(partition)


class PayloadStream(DataSourceStreamReader):
    """New and changed files, each version once. A file is known by path, length and time of change.

    Every offset is an entry of the ``log``, the list of files that came to light with it, written before the engine hears of the offset: a
    batch that is run again after a crash reads the same files. The time of change alone settles nothing, so files that arrive late or
    with old dates are read too. A file removed between its entry and its batch ends the batch with an error.
    """

    def __init__(self, tree: Tree, log: str):
        self.tree = tree
        self.system, self.log, _ = raw.located(log.rstrip("/"))
        self.known: set[Found] = set()
        self.entries = 0

    def initialOffset(self) -> dict:
        return {"entries": 0}

    def latestOffset(self) -> dict:
        self.catch_up()
        new = [f for f in self.tree.files() if f not in self.known]
        if new:
            self.system.create_dir(self.log, recursive=True)
            place = self.place(self.entries + 1)
            with self.system.open_output_stream(place + ".part") as stream:
                stream.write("\n".join(json.dumps([f.source_key, f.bronze_path, f.length, f.modified_ms]) for f in new).encode())
            self.system.move(place + ".part", place)
            self.catch_up()
        return {"entries": self.entries}

    def place(self, entry: int) -> str:
        return f"{self.log}/{entry:09d}.jsonl"

    def entry(self, number: int) -> list[Found]:
        with self.system.open_input_stream(self.place(number)) as stream:
            return [Found(*json.loads(line)) for line in stream.read().decode().splitlines()]

    def catch_up(self) -> None:
        while self.system.get_file_info([self.place(self.entries + 1)])[0].type == afs.FileType.File:
            self.entries += 1
            self.known.update(self.entry(self.entries))

    def partitions(self, start: dict, end: dict) -> list[Files]:
        files = [f for n in range(start["entries"] + 1, end["entries"] + 1) for f in self.entry(n)]
        return self.tree.dealt(files)

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        return contents(partition)


class PayloadSource(DataSource):
    """Options: path, key (name of the key directories), name_glob, bytes_per_task; for streams also log (a folder of its own)."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PayloadReader:
        return PayloadReader(Tree.of(self.options))

    def streamReader(self, schema) -> PayloadStream:
        if "log" not in self.options:
            raise ValueError("a stream of payload_files needs a log folder")
        return PayloadStream(Tree.of(self.options), self.options["log"])


def register(spark: SparkSession) -> None:
    """Make ``payload_files`` known to a session, filters included."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PayloadSource)

"""Raw payload files: listed, read and written one by one.

Payloads carry names such as ``_raw.json`` that Spark's own file sources hide, and a payload is a whole file whatever its
lines. Tasks therefore list and read the files themselves, through Arrow's file systems; the driver sees only the
roots. Works for local paths and for the object stores and HDFS that Arrow knows.
"""

from __future__ import annotations

import fnmatch
import os
import re
import sys
import uuid
from collections.abc import Iterator
from itertools import groupby, islice
from urllib.parse import quote, unquote, urlparse

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as afs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidelake.session import checkpointed

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need no copy of this package

#: Files that Spark and Hadoop leave beside data; everything else counts, also with a leading underscore.
MARKERS = re.compile(r"^(\.|_SUCCESS$|_temporary$|_started_|_committed_|_spark_metadata$)")
BYTES_PER_TASK = 64 << 20
#: What opening a file counts as, and the bytes of a batch of small files.
OPEN_BYTES, BATCH_BYTES = 16 << 10, 1 << 20
#: Rows that a batch from a task holds at most.
ROWS_PER_BATCH = 10_000
FILES = "path string, length bigint, modified_ms bigint"
#: Characters that Spark escapes in names of partition directories, and its name for a missing value.
ESCAPED, NO_VALUE = re.compile("[\x01-\x1f\"#%'*/:=?\\\\\x7f{\\[\\]^]"), "__HIVE_DEFAULT_PARTITION__"


def located(path: str) -> tuple[afs.FileSystem, str, str]:
    """File system, path within it, and what turns such paths into full ones again."""
    if not urlparse(path).scheme:
        return afs.LocalFileSystem(), path, ""
    if path.startswith("file:"):
        return afs.LocalFileSystem(), unquote(re.sub("^file:/*", "/", path)), ""
    system, inner = afs.FileSystem.from_uri(path)
    return system, inner, path[:len(path) - len(inner)] if path.endswith(inner) else urlparse(path).scheme + "://"


def _below(system: afs.FileSystem, directory: str) -> Iterator[tuple[str, bool]]:
    """Path of each entry right below a directory and whether it is one itself. Local ones are read entry by entry, so any number fits."""
    if isinstance(system, afs.LocalFileSystem):
        try:
            with os.scandir(directory) as entries:
                for x in entries:
                    yield x.path, x.is_dir()
        except FileNotFoundError:  # gone meanwhile
            return
    else:
        for x in system.get_file_info(afs.FileSelector(directory, allow_not_found=True)):
            yield x.path, x.type == afs.FileType.Directory


def _visible(path: str, root: str) -> bool:
    return not any(MARKERS.match(part) for part in path[len(root.rstrip("/")) + 1:].split("/"))


def list_files(spark: SparkSession, root: str | list[str], name_glob: str = "*") -> DataFrame:
    """``(path, length, modified_ms)`` of all files below the roots whose name fits; contents are not read.

    A root may be a file. A task lists what lies right below each root and others the directories found there, so that the driver holds
    neither files nor directories, of which a root has as many as keys.
    """
    tops: list[tuple[str, str, bool]] = []  # root, directory or file, whether to list it
    for top in [root] if isinstance(root, str) else root:
        system, inner, prefix = located(top)
        [info] = system.get_file_info([inner])
        if info.type == afs.FileType.NotFound:
            raise FileNotFoundError(top)
        is_file = info.type == afs.FileType.File
        tops.append((prefix + (inner.rsplit("/", 1)[0] if is_file else inner), prefix + inner, not is_file))
    if not tops:
        return spark.createDataFrame([], FILES)

    def batched(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        while some := list(islice(rows, ROWS_PER_BATCH)):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), schema.types)], schema=schema)

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str, bool]]:
        for row in (row for batch in batches for row in batch.to_pylist()):
            system, inner, prefix = located(row["start"])
            if row["descend"]:
                yield from ((row["root"], prefix + path, is_directory) for path, is_directory in _below(system, inner))
            else:
                yield row["root"], row["start"], False

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int]]:
        for row in (row for batch in batches for row in batch.to_pylist()):
            system, inner, prefix = located(row["start"])
            top = located(row["root"])[1]
            for x in system.get_file_info(afs.FileSelector(inner, recursive=True)) if row["descend"] else system.get_file_info([inner]):
                if x.type == afs.FileType.File and fnmatch.fnmatchcase(x.base_name, name_glob) and _visible(x.path, top):
                    yield prefix + x.path, x.size, x.mtime_ns // 1_000_000 if x.mtime_ns else 0

    starts = pa.schema([("root", pa.string()), ("start", pa.string()), ("descend", pa.bool_())])
    listed = pa.schema([("path", pa.string()), ("length", pa.int64()), ("modified_ms", pa.int64())])
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = spark.createDataFrame(tops, "root string, start string, descend boolean")
    if any(descend for *_, descend in tops):
        rows = rows.repartition(min(len(tops), tasks)).mapInArrow(lambda x: batched(entries(x), starts), rows.schema)
    return rows.repartition(tasks, "start").mapInArrow(lambda x: batched(found(x), listed), FILES)


def key_of(path: Column | str, name: str | None = None) -> Column:
    """Key from the directory a file lies in: the value of ``name=`` or of the last ``x=`` directory."""
    column = F.col(path) if isinstance(path, str) else path
    pattern = rf"/{name}=([^/]+)/" if name else r".*/[^/=]+=([^/]+)/[^/]*$"
    return F.url_decode(F.regexp_replace(F.regexp_extract(column, pattern, 1), r"\+", "%2B"))


def read_payloads(spark: SparkSession, root: str | list[str], name_glob: str = "*") -> DataFrame:
    """``(source_key, bronze_path, raw)``: one row per file, with its whole text. Bytes that are no UTF-8 become U+FFFD.

    The files are those that are there at the call. Only names travel before the read; they are dealt to tasks by size, about 64 MB or 4000
    small files each, so one key may hold any number of files.
    """
    files = checkpointed(list_files(spark, root, name_glob))
    total = files.agg(F.sum(F.greatest("length", F.lit(OPEN_BYTES)))).first()[0] or 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths: list[str] = []
        texts: list[str] = []
        size = 0
        for path in (path for batch in batches for path in batch.column("path").to_pylist()):
            system, inner, _ = located(path)
            with system.open_input_stream(inner) as stream:
                raw = stream.read()
            if paths and (size + len(raw) > BATCH_BYTES or len(paths) == ROWS_PER_BATCH):
                yield packed(paths, texts)
                paths, texts, size = [], [], 0
            paths.append(path)
            texts.append(raw.decode("utf-8", "replace"))
            size += len(raw)
        if paths:
            yield packed(paths, texts)

    def packed(paths: list[str], texts: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(paths), pa.array(texts, pa.large_string()).cast(pa.string())], names=["bronze_path", "raw"])

    dealt = files.select("path").repartition(max(1, -(-total // BYTES_PER_TASK)), F.xxhash64("path"))
    return dealt.mapInArrow(run, "bronze_path string, raw string").select(key_of("bronze_path").alias("source_key"), "bronze_path", "raw")


def write_payloads(payloads: DataFrame, root: str, key: str, text: str = "raw", page: str | None = None,
                   history: str | None = None) -> DataFrame:
    """One file per payload: ``key=<value>/_raw.json``, or ``_raw_page=<n>.json`` where a column gives the page.

    Several payloads of a key without pages are told apart by a digest in the name, so a task that is run again writes the
    same files. What a key held before is replaced: files of the written keys that this write did not make are removed
    once all new ones are there. With ``history``, a time stamp, the files lie below ``ingest_ts=<history>/`` and nothing is
    removed. Returns the ``(path)`` of every file written. A null key or text is not written.
    """
    several = F.col("_payloads") > 1
    name = (F.concat(F.lit("_raw_page="), F.col(page).cast("string"), F.lit(".json")) if page else
            F.when(several, F.concat(F.lit("_raw-"), F.substring(F.sha2(F.col(text), 256), 1, 24), F.lit(".json"))).otherwise("_raw.json"))
    digests = payloads.where(F.col(key).isNotNull() & F.col(text).isNotNull()).withColumn("_digest", F.sha2(F.col(text), 256))
    rows = digests.dropDuplicates([key, "_digest", *([page] if page else [])])
    # counted on digests alone, so that a hot key's texts do not meet in one task
    counts = rows.groupBy(key).agg(F.count("*").alias("_payloads"))
    keyed = rows.join(counts, key).select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"), name.alias("name"))
    folder, below = f"{root.rstrip('/')}/{key}=", f"/ingest_ts={history}" if history else ""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = []
            for row in batch.to_pylist():
                path = f"{folder}{quote(row['key'], safe=' ')}{below}/{row['name']}"
                system, inner, prefix = located(path)
                system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
                with system.open_output_stream(inner) as stream:
                    stream.write(row["text"].encode())
                paths.append(prefix + inner)
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string())], names=["path"])

    # dealt by number, since adaptive execution puts small texts into few tasks however many files they are
    tasks = max(1, int(payloads.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    written = checkpointed(keyed.repartition(tasks, "key", "name").mapInArrow(write, "path string"))

    if history:
        return written

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for at, rows in groupby((row for batch in batches for row in batch.to_pylist()), lambda row: row["directory"]):
            own = {row["path"] for row in rows}
            system, inner, prefix = located(at)
            gone = [x.path for x in system.get_file_info(afs.FileSelector(inner)) if x.type == afs.FileType.File
                    and prefix + x.path not in own]
            for path in gone:
                system.delete_file(path)
            if gone:
                yield pa.RecordBatch.from_arrays([pa.array([len(gone)], pa.int64())], names=["gone"])

    _by_directory(written.withColumn("directory", F.regexp_extract("path", "^(.*)/[^/]*$", 1))).mapInArrow(sweep, "gone bigint").agg(
        F.sum("gone")).first()
    return written


def directory(key: str, value: str | None) -> str:
    """Name of a partition directory, as Spark's writers spell it."""
    return f"{key}=" + (ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", value) if value else NO_VALUE)


def _spread(lines: DataFrame, key: str) -> DataFrame:
    """Rows of a key side by side, a key with more than a task's share over several tasks. Keys are counted before any text is computed."""
    parts = max(1, int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    counts = lines.groupBy(F.col(key).alias("_large")).agg(F.count(F.lit(1)).alias("_rows"))
    counts = checkpointed(counts)
    share = (counts.agg(F.sum("_rows")).first()[0] or 0) / parts
    large = counts.where(F.col("_rows") > share).withColumn("_pieces", F.ceil(F.col("_rows") / F.lit(share)))  # fewer than there are tasks
    placed = lines.join(F.broadcast(large), F.col(key).eqNullSafe(F.col("_large")), "left")
    piece = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in lines.columns]), F.coalesce("_pieces", F.lit(1)))
    return placed.withColumn("_piece", piece).repartition(key, "_piece").select(*[F.col(f"`{c}`") for c in lines.columns])


def write_lines(lines: DataFrame, root: str, key: str, suffix: str = ".txt") -> None:
    """Lines of text below ``key=<value>/``, one file at least for each key; what the written keys held before is replaced.

    Tasks write below a hidden directory and, once all lines are there, move the files to their directories. A write that fails before
    that changes nothing, and no single process commits the files one after another, of which there are as many as keys.
    """
    [text] = [c for c in lines.columns if c != key]
    write_id = uuid.uuid4().hex
    system, top, _ = located(root.rstrip("/"))
    staging = f"{top}/.lines-{write_id}"
    system.create_dir(staging, recursive=True)
    rows = _spread(lines, key).select(F.col(key).cast("string").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = located(root)[0]
        context = TaskContext.get()
        folder, name = f"{staging}/{context.taskAttemptId()}", f"part-{context.partitionId():05d}-{write_id}{suffix}"
        made: list[tuple[str, str]] = []
        stream, current = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            values = pc.binary_join_element_wise(batch.column("text"), "", "\n")  # the last argument stands between the others
            starts = memoryview(values.buffers()[1]).cast("i")[values.offset:values.offset + len(values) + 1]
            data, at = memoryview(values.buffers()[2]), 0
            for value, run in groupby(batch.column("key").to_pylist()):
                end = at + sum(1 for _ in run)
                place = directory(key, value)
                if place != current:
                    if stream is None:
                        store.create_dir(folder, recursive=True)
                    else:
                        stream.close()
                    current = place
                    made.append((f"{folder}/{len(made)}", f"{top}/{place}"))
                    stream = store.open_output_stream(made[-1][0])
                stream.write(data[starts[at]:starts[end]])
                at = end
        if stream is not None:
            stream.close()
        for k in range(0, len(made), ROWS_PER_BATCH):
            some = made[k:k + ROWS_PER_BATCH]
            yield pa.RecordBatch.from_arrays([pa.array([m[0] for m in some], pa.string()), pa.array([m[1] for m in some], pa.string()),
                                              pa.array([name] * len(some), pa.string())], names=["staged", "directory", "name"])

    try:
        written = checkpointed(rows.sortWithinPartitions("key").mapInArrow(write, "staged string, directory string, name string"))
    except Exception:
        system.delete_dir(staging)
        raise

    def publish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = located(root)[0]
        for at, group in groupby((row for batch in batches for row in batch.to_pylist()), lambda row: row["directory"]):
            own = {row["name"]: row["staged"] for row in group}
            store.create_dir(at, recursive=True)
            for name, staged in own.items():
                if store.get_file_info([staged])[0].type == afs.FileType.File:  # else this task has run before
                    store.move(staged, f"{at}/{name}")
            gone = [x.path for x in store.get_file_info(afs.FileSelector(at)) if x.type == afs.FileType.File and x.base_name not in own]
            for path in gone:
                store.delete_file(path)
            if gone:
                yield pa.RecordBatch.from_arrays([pa.array([len(gone)], pa.int64())], names=["gone"])

    _by_directory(written).mapInArrow(publish, "gone bigint").agg(F.sum("gone")).first()
    system.delete_dir(staging)


def _by_directory(files: DataFrame) -> DataFrame:
    """Files of a directory one after another in one task."""
    tasks = max(1, int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return files.repartition(tasks, "directory").sortWithinPartitions("directory")

"""Tables of Parquet files whose versions are lists of files: a write over any number of partitions is one commit.

A version is a Parquet list of the table's files with their partition values, row counts and the least and greatest values of the
clustering columns. It becomes current when its entry appears in the log, which can happen once only for a number. Readers take the
newest entry, so they see one version whole; files that a failed write left are in no version, and ``expire`` removes them.
Writers that began at the same version are both kept if no file was replaced by both; else the later one fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DataType, IntegerType, LongType, MapType, StringType, StructField, StructType

from tidelake.operators import layout
from tidelake.session import checkpointed
from tidelake.sources import raw

#: A row's file; the metadata column gives it as a URI.
URI = "_metadata.file_path"


def path_of(uri: Column | str) -> Column:
    """Path that a URI of the metadata column means."""
    return F.url_decode(F.regexp_replace(uri, r"\+", "%2B"))


def nullable(schema: DataType) -> DataType:
    """The type with nulls allowed everywhere, as Parquet gives it back."""
    if isinstance(schema, StructType):
        return StructType([StructField(f.name, nullable(f.dataType)) for f in schema.fields])
    if isinstance(schema, ArrayType):
        return ArrayType(nullable(schema.elementType))
    if isinstance(schema, MapType):
        return MapType(nullable(schema.keyType), nullable(schema.valueType))
    return schema


class ConflictError(Exception):
    """Another writer has replaced what this write is based on."""


class VersionedTable:
    """A table below ``root``, partitioned by ``partition_by`` and clustered by ``cluster_by`` (also the columns with file statistics).

    The schema is that of the first write; later writes must have its columns, in any order. A null is a partition value as any
    other. An empty write makes a version too.
    """

    def __init__(self, spark: SparkSession, root: str, partition_by: Sequence[str] = (), cluster_by: Sequence[str] = (),
                 rows_per_file: int = 0, along_curve: bool = False):
        self.rows_per_file = rows_per_file  # at most; 0: a file per task and partition
        self.along_curve = along_curve  # clustered by all columns alike, each file narrow in every one; else by the first, then the next
        self.spark, self.root = spark, root.rstrip("/")
        self.partition_by, self.cluster_by = list(partition_by), list(cluster_by)

    # --- log -------------------------------------------------------------------

    def _hadoop(self):
        jvm = self.spark.sparkContext._jvm
        path = lambda p: jvm.org.apache.hadoop.fs.Path(p)
        return path, path(self.root).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), jvm

    def versions(self) -> list[int]:
        path, system, _ = self._hadoop()
        log = path(f"{self.root}/log")
        if not system.exists(log):
            return []
        names = [status.getPath().getName() for status in system.listStatus(log)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def version(self) -> int | None:
        return max(self.versions(), default=None)

    def entry(self, version: int) -> dict:
        path, system, jvm = self._hadoop()
        stream = system.open(path(f"{self.root}/log/{version:020d}.json"))
        try:
            return json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _publish(self, version: int, entry: dict) -> bool:
        """Make an entry appear whole under its number; False where another writer has taken the number."""
        path, system, jvm = self._hadoop()
        target, waiting = path(f"{self.root}/log/{version:020d}.json"), path(f"{self.root}/log/_{uuid.uuid4().hex}")
        stream = system.create(waiting, False)
        stream.write(bytearray(json.dumps(entry).encode()))
        stream.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        none[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        try:
            context.rename(system.makeQualified(waiting), system.makeQualified(target), none)
            return True
        except Exception as error:  # noqa: BLE001  (the gateway wraps Java's exceptions)
            system.delete(waiting, False)
            if "FileAlreadyExistsException" in str(error):
                return False
            raise

    # --- reading ---------------------------------------------------------------

    def files(self, version: int | None = None) -> DataFrame:
        """(path, part, rows, least, greatest) of each file of a version."""
        at = self.version() if version is None else version
        if at is None:
            raise FileNotFoundError(self.root)
        return self.spark.read.schema(self._list_schema(self.schema(at))).parquet(self.entry(at)["files"])

    def schema(self, version: int | None = None) -> StructType:
        at = self.version() if version is None else version
        if at is None:
            raise FileNotFoundError(self.root)
        return StructType.fromJson(self.entry(at)["schema"])

    def _list_schema(self, schema: StructType) -> StructType:
        pick = lambda names: StructType([schema[c] for c in names]) if names else StructType().add("none", IntegerType())
        bounds = pick(self.cluster_by)
        return (StructType().add("path", StringType()).add("part", pick(self.partition_by)).add("rows", LongType())
                .add("least", bounds).add("greatest", bounds))

    @staticmethod
    def _of_each(names: list[str], function: Callable[[str], Column]) -> Column:
        return F.struct(*[function(c).alias(c) for c in names] or [F.lit(None).cast("int").alias("none")])

    def read(self, version: int | None = None, files: Column | None = None) -> DataFrame:
        """Rows of a version; ``files`` is a condition on the file list that leaves out files beforehand."""
        at = self.version() if version is None else version
        return self._rows(self._paths(self.files(at), files), self.schema(at))

    @staticmethod
    def _paths(files: DataFrame, condition: Column | None = None) -> list[str]:
        return [r["path"] for r in (files if condition is None else files.where(condition)).select("path").collect()]  # names only

    def _rows(self, paths: list[str], schema: StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def where_part(self, **values: object) -> Column:
        """Condition on the file list: files of these partitions."""
        return self._all([F.col(f"part.{c}").eqNullSafe(F.lit(v)) for c, v in values.items()])

    def where_between(self, column: str, low: object, high: object) -> Column:
        """Condition on the file list: files that may hold values of a clustering column from low to high."""
        return (F.col(f"greatest.{column}") >= F.lit(low)) & (F.col(f"least.{column}") <= F.lit(high))

    @staticmethod
    def _all(conditions: list[Column]) -> Column:
        out = F.lit(True)
        for c in conditions:
            out &= c
        return out

    # --- writing ---------------------------------------------------------------

    def _store(self, rows: DataFrame) -> DataFrame:
        """Write rows as new files, one partition to a file, clustered; their list."""
        target = f"{self.root}/data/{uuid.uuid4().hex}"
        order = [*self.partition_by, *[c for c in self.cluster_by if c not in self.partition_by]]
        if self.along_curve and self.cluster_by:
            placed = rows.withColumn("__curve", layout.curve(rows, self.cluster_by))
            order = [*self.partition_by, "__curve", *self.cluster_by]
            rows = placed.repartitionByRange(*order).sortWithinPartitions(*order).drop("__curve")
        elif order:
            rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
        # directories have plain names of their own, so that any value may be that of a partition and files hold all columns
        name = F.sha2(F.to_json(F.struct(*self.partition_by), {"ignoreNullFields": "false"}), 256) if self.partition_by else F.lit("all")
        rows.withColumn("__part", name).write.partitionBy("__part").option("maxRecordsPerFile", self.rows_per_file).option(
            "compression", "zstd").parquet(target)
        stored = self.spark.read.schema(rows.schema).option("recursiveFileLookup", True).parquet(target)
        listed = stored.groupBy(F.col(URI).alias("uri")).agg(
            self._of_each(self.partition_by, F.first).alias("part"), F.count(F.lit(1)).alias("rows"),
            self._of_each(self.cluster_by, F.min).alias("least"), self._of_each(self.cluster_by, F.max).alias("greatest"))
        return listed.select(path_of("uri").alias("path"), "part", "rows", "least", "greatest")  # decoded once a file, not once a row

    def _commit(self, schema: StructType, added: DataFrame | None, gone: Callable[[DataFrame], DataFrame] | None, kind: str,
                based_on: int | None) -> int:
        """Publish the list of kept and added files. ``gone(files)`` are those to leave out; another writer's commit in between is
        kept, unless it too replaced one of the files that ``gone`` finds, or added files that it would have found.
        """
        if added is not None:
            place = f"{self.root}/lists/{uuid.uuid4().hex}"
            added.write.parquet(place)
            added = self.spark.read.schema(self._list_schema(schema)).parquet(place)
        base_gone = None
        if gone is not None and based_on is not None:
            base_gone = f"{self.root}/lists/{uuid.uuid4().hex}"
            gone(self.files(based_on)).select("path").write.parquet(base_gone)
            base_gone = self.spark.read.schema("path string").parquet(base_gone)
        while True:
            at = self.version()
            kept = None if at is None else self.files(at)
            if gone is not None and at != based_on:
                now = gone(kept).select("path")
                if base_gone is None or not (now.exceptAll(base_gone).isEmpty() and base_gone.exceptAll(now).isEmpty()):
                    raise ConflictError(f"{self.root}: version {at} replaced files that this write of version {based_on} replaces")
            if kept is not None and base_gone is not None:
                kept = kept.join(base_gone, "path", "left_anti")
            every = kept if added is None else added if kept is None else kept.unionByName(added)
            place = f"{self.root}/lists/{uuid.uuid4().hex}"
            (self.spark.createDataFrame([], self._list_schema(schema)) if every is None else every).write.parquet(place)
            number = 0 if at is None else at + 1
            if self._publish(number, {"files": place, "schema": json.loads(schema.json()), "kind": kind, "based_on": based_on}):
                return number

    def _shaped(self, rows: DataFrame) -> tuple[DataFrame, StructType]:
        at = self.version()
        if at is None:
            return rows, nullable(rows.schema)
        schema = self.schema(at)
        return rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields]), schema

    def append(self, rows: DataFrame) -> int:
        rows, schema = self._shaped(rows)
        return self._commit(schema, self._store(rows), None, "append", self.version())

    def overwrite(self, rows: DataFrame) -> int:
        """A version of these rows alone."""
        based_on = self.version()
        rows, schema = self._shaped(rows)
        return self._commit(schema, self._store(rows), lambda files: files, "overwrite", based_on)

    def replace_partitions(self, rows: DataFrame) -> int:
        """Replace exactly the partitions that occur in the rows, in one commit."""
        based_on = self.version()
        rows, schema = self._shaped(rows)
        added = self._store(rows)
        touched = added.select("part").distinct()

        def gone(files: DataFrame) -> DataFrame:
            same = [F.col(f"part.{c}").eqNullSafe(F.col(f"touched.{c}")) for c in self.partition_by]
            return files.join(touched.withColumnRenamed("part", "touched"), self._all(same), "left_semi")
        return self._commit(schema, added, gone, "replace partitions", based_on)

    def replace_keys(self, rows: DataFrame, keys: DataFrame, bounds: Column | None = None) -> int | None:
        """Replace all rows whose key is in ``keys`` by ``rows``; only files that hold such a key are written anew.

        ``keys`` has columns of the table and may name keys that it does not hold, ``rows`` has keys of them only. ``bounds`` is a condition on the file list
        that all files with such keys fulfil; a null in a key is a value. None where nothing is to be done.
        """
        based_on = self.version()
        if based_on is None:
            return self._commit(nullable(rows.schema), self._store(rows), None, "replace keys", None)
        rows, schema = self._shaped(rows)
        keys = keys.distinct()
        mine = keys.select([F.col(f"`{c}`").alias(f"__key_{c}") for c in keys.columns])
        same = lambda: self._all([F.col(f"`{c}`").eqNullSafe(F.col(f"__key_{c}")) for c in keys.columns])

        def holding(paths: list[str]) -> list[str]:  # names only
            if not paths:
                return []
            found = self._rows(paths, schema).withColumn("__uri", F.col(URI)).join(mine, same(), "left_semi")
            return [r["path"] for r in found.select("__uri").distinct().select(path_of("__uri").alias("path")).collect()]

        held = holding(self._paths(self.files(based_on), bounds))
        if not held and rows.isEmpty():
            return None
        rest = self._rows(held, schema).join(mine, same(), "left_anti")

        def gone(files: DataFrame) -> DataFrame:
            late = holding(self._paths(files.join(self.files(based_on), "path", "left_anti")))
            return files.join(self.spark.createDataFrame([(p,) for p in held + late], "path string"), "path", "left_semi")
        return self._commit(schema, self._store(rest.unionByName(rows)), gone, "replace keys", based_on)

    # --- clean-up --------------------------------------------------------------

    def expire(self, keep: int = 1, older_than_ms: int | None = None) -> int:
        """Forget all but the newest ``keep`` versions and delete what no remaining one has; how many directories and files went.

        What a write in progress has made is in no version yet: ``older_than_ms`` (since the epoch) spares younger directories.
        """
        found = self.versions()
        kept, forgotten = found[-keep:], found[:-keep]
        path, system, _ = self._hadoop()
        if not kept:
            return 0
        for version in forgotten:
            system.delete(path(f"{self.root}/log/{version:020d}.json"), False)
        paths = self.files(kept[0]).select("path")
        for version in kept[1:]:
            paths = paths.union(self.files(version).select("path"))
        tails = paths.select(F.regexp_extract("path", r"/data/([0-9a-f]{32}/.*)$", 1).alias("tail")).distinct()
        used = {r[0] for r in tails.select(F.substring("tail", 1, 32)).distinct().collect()}  # one per write
        used |= {self.entry(v)["files"].rsplit("/", 1)[-1] for v in kept}
        gone, parts = 0, []
        for place in ("data", "lists"):
            for status in system.listStatus(path(f"{self.root}/{place}")):
                name = status.getPath().getName()
                if older_than_ms is not None and status.getModificationTime() >= older_than_ms:
                    continue
                if name not in used:
                    gone += bool(system.delete(status.getPath(), True))
                elif place == "data":
                    parts.append(f"{self.root}/data/{name}")
        if not parts:
            return gone
        listed = raw.list_files(self.spark, parts).withColumn("tail", F.regexp_extract("path", r"/data/([0-9a-f]{32}/.*)$", 1))

        def delete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for name in batch.column("path").to_pylist():
                    store, inner, _ = raw.located(name)
                    store.delete_file(inner)
                yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["gone"])

        stale = checkpointed(listed.join(tails, "tail", "left_anti").select("path"))
        return gone + stale.mapInArrow(delete, "gone bigint").agg(F.coalesce(F.sum("gone"), F.lit(0))).first()[0]

"""Incremental jobs: file streams with explicit schemas, run to completion or kept running.

No job drops late rows. Bars and duplicates keep no state in the engine: every micro-batch writes a directory of its own to a
log, which readers resolve, so rows may arrive in any order and however late, and a replayed batch overwrites its directory.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from tidelake.operators.dedup import keep_latest
from tidelake.sources.writers import write_partitioned

BATCH = "batch_id"


def file_stream(spark: SparkSession, path: str, schema: StructType | str, source: str = "parquet",
                name_glob: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    """Stream of the files of a directory, such as a table's part files, or of one file."""
    target = _hadoop(spark, path)
    if name_glob is None and _system(spark, path).isFile(target):
        path, name_glob = target.getParent().toString(), target.getName()
    reader = spark.readStream.format(source).schema(schema)
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def _started(writer: DataStreamWriter, checkpoint: str, interval: str | None) -> StreamingQuery:
    """Run to completion, or with an ``interval`` keep running."""
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


def start_merge(stream: DataFrame, table_path: str, stage_path: str, checkpoint: str, schema: StructType | str,
                keys: Sequence[str], newest_first: Callable[[], Sequence[Column]],
                partition_by: Sequence[str] = ("year",), interval: str | None = None) -> StreamingQuery:
    """Merge every micro-batch into a partitioned table, keeping the newest version per key.

    The partition columns must follow from the key, as the year follows from a date; where late rows are common, take finer ones,
    such as the month, since a touched partition is rewritten. Only touched partitions are read: the scan is pruned by a
    join with the batch's partition values. The merged partitions are staged first. A replayed batch republishes a finished
    stage instead of merging again, so a failure while partitions are being replaced loses nothing. A batch removes the
    stages before its own.
    """
    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stage = f"{stage_path}/{BATCH}={batch_id}"
        if not _exists(spark, f"{stage}/_SUCCESS"):
            rows = batch
            if _exists(spark, table_path):
                current = _touched(spark.read.schema(schema).parquet(table_path), batch, partition_by)
                rows = current.unionByName(batch.select(*current.columns))
            merged = keep_latest(rows, keys, newest_first())
            merged.write.mode("overwrite").option("compression", "zstd").parquet(stage)
        write_partitioned(spark.read.parquet(stage), table_path, partition_by, keys)
        _remove_batches(spark, stage_path, batch_id - 1)

    return _started(stream.writeStream.foreachBatch(merge), checkpoint, interval)


def _touched(current: DataFrame, batch: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of the partitions that a batch touches, whatever their number; a null value is a partition too."""
    values = batch.select(*[F.col(c).alias(f"_touched_{c}") for c in partition_by]).distinct()
    equal = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_touched_{c}") for c in partition_by])
    found = current.join(F.broadcast(values), equal, "left_semi")  # one row per directory
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in partition_by])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_touched_{c}")) for c in partition_by])
    return found.unionByName(current.where(missing).join(F.broadcast(values), same, "left_semi"))


def _hadoop(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path: str):
    return _hadoop(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    return _system(spark, path).exists(_hadoop(spark, path))


def _batches(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete batches of a log or stage."""
    if not _exists(spark, path):
        return []
    names = [f.getPath().getName() for f in _system(spark, path).listStatus(_hadoop(spark, path))]
    return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{BATCH}=") and _exists(spark, f"{path}/{n}/_SUCCESS"))


def _remove_batches(spark: SparkSession, path: str, last: int) -> None:
    for batch in _batches(spark, path):
        if batch <= last:
            _system(spark, path).delete(_hadoop(spark, f"{path}/{BATCH}={batch}"), True)


# --- logs ---------------------------------------------------------------------------

def start_log(rows: DataFrame, log_path: str, checkpoint: str, reduce_batch: Callable[[DataFrame], DataFrame] = lambda b: b,
              interval: str | None = None) -> StreamingQuery:
    """Write what ``reduce_batch`` makes of every micro-batch to a directory of that batch; a replay overwrites it."""
    def write(batch: DataFrame, batch_id: int) -> None:
        reduce_batch(batch).write.mode("overwrite").option("compression", "zstd").parquet(f"{log_path}/new/{BATCH}={batch_id}")

    return _started(rows.writeStream.foreachBatch(write), checkpoint, interval)


def _log_parts(spark: SparkSession, log_path: str, schema: StructType | None = None, before: int | None = None) -> list[DataFrame]:
    """The batches after the newest compacted part, only those ``before`` one if given, and that part; either may be missing."""
    def reader():
        return spark.read if schema is None else spark.read.schema(schema)

    base, parts = _batches(spark, f"{log_path}/compact"), []
    newest = base[-1] if base else -1
    if base:
        folded = reader().parquet(f"{log_path}/compact/{BATCH}={newest}").withColumn(BATCH, F.lit(newest))
        parts.append(folded)
        schema = folded.schema  # batches without a new key have no file to tell it
    paths = [f"{log_path}/new/{BATCH}={b}" for b in _batches(spark, f"{log_path}/new") if b > newest and (before is None or b < before)]
    if paths:
        parts.append(reader().option("basePath", f"{log_path}/new").parquet(*paths))
    return parts


def read_log(spark: SparkSession, log_path: str) -> DataFrame:
    """Rows of the newest compacted part and of all batches after it, with their ``batch_id``."""
    return reduce(DataFrame.unionByName, _log_parts(spark, log_path))


def compact_log(spark: SparkSession, log_path: str, merge: Callable[[DataFrame], DataFrame],
                partition_by: Sequence[str] = ()) -> None:
    """Replace all batches so far by one part, made by ``merge``, so that reads do not slow down with the log's age.

    The part counts once it is complete; only then what it replaces is removed. Run it between batches, not beside them.
    """
    batches = _batches(spark, f"{log_path}/new")
    older = _batches(spark, f"{log_path}/compact")
    if not batches or older and batches[-1] <= older[-1]:
        return
    merge(read_log(spark, log_path).drop(BATCH)).write.mode("overwrite").option("compression", "zstd").partitionBy(*partition_by).parquet(
        f"{log_path}/compact/{BATCH}={batches[-1]}")
    _remove_batches(spark, f"{log_path}/compact", batches[-1] - 1)
    _remove_batches(spark, f"{log_path}/new", batches[-1])


# --- bars ---------------------------------------------------------------------------

def partial_bars(ticks: DataFrame, duration: str, sequence: Column) -> DataFrame:
    """Tumbling bars of some ticks ``(symbol, ts, price, volume)``, in a form that can be merged with bars of other ticks."""
    tick = F.struct(sequence.alias("sequence"), F.col("price").alias("price"))
    return ticks.groupBy("symbol", F.window("ts", duration).start.alias("window_start")).agg(
        F.min(tick).alias("first"), F.max(tick).alias("last"), F.max("price").alias("high"), F.min("price").alias("low"),
        F.sum("volume").alias("volume"), F.count(F.lit(1)).alias("trades"))


def merged_bars(partial: DataFrame) -> DataFrame:
    return partial.groupBy("symbol", "window_start").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.max("high").alias("high"), F.min("low").alias("low"),
        F.sum("volume").alias("volume"), F.sum("trades").alias("trades"))


def start_bars(ticks: DataFrame, log_path: str, checkpoint: str, duration: str, sequence: Callable[[], Column],
               interval: str | None = None) -> StreamingQuery:
    """Bars of a tick stream as partial bars per micro-batch. Ticks may come in any order and however late."""
    return start_log(ticks, log_path, checkpoint, lambda batch: partial_bars(batch, duration, sequence()), interval)


def read_bars(spark: SparkSession, log_path: str) -> DataFrame:
    """Current bars: equal to the batch bars over all ticks so far."""
    return merged_bars(read_log(spark, log_path)).select(
        "symbol", "window_start", F.col("first.price").alias("open"), "high", "low", F.col("last.price").alias("close"),
        "volume", "trades")


# --- duplicates ----------------------------------------------------------------------

def start_distinct(stream: DataFrame, log_path: str, checkpoint: str, keys: Sequence[str], day: Column,
                   interval: str | None = None) -> StreamingQuery:
    """Keep the first row of every key, however far apart repeats arrive.

    ``day`` must follow from the keys. A batch is compared with the log's rows of its own days only; the log is
    partitioned by them, its compacted part too. A replayed batch sees the same earlier batches and writes the same rows again; if
    they were compacted meanwhile, it finds them all known, and its directory is not read.
    """
    named = ["_day", *keys]

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = keep_latest(batch.withColumn("_day", day), named, [])
        parts = [_touched(p.select(*named), rows, ["_day"]) for p in _log_parts(spark, log_path, rows.schema, batch_id)]
        if parts:
            known = reduce(DataFrame.unionByName, parts).select(*[F.col(c).alias(f"_known_{c}") for c in named])
            same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_known_{c}")) for c in named])
            rows = rows.join(known, same, "left_anti")
        rows.write.mode("overwrite").option("compression", "zstd").partitionBy("_day").parquet(f"{log_path}/new/{BATCH}={batch_id}")

    return _started(stream.writeStream.foreachBatch(write), checkpoint, interval)


def compact_distinct(spark: SparkSession, log_path: str, keys: Sequence[str]) -> None:
    """Fold the log of duplicates into one part, by day; see ``compact_log``."""
    compact_log(spark, log_path, lambda rows: rows.repartitionByRange("_day", *keys), ["_day"])


def read_distinct(spark: SparkSession, log_path: str) -> DataFrame:
    return read_log(spark, log_path).drop(BATCH, "_day")
